"""A table of terms against the plan of literals, and against plain search."""

import random
import re

from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import lexicon, scoring
from inkwell.sources.rules import DEMO, Rules

SF = "/root/testdata/sf0.001"
RESULTS = ["financial_score", "financial_label", "pr_score", "pr_label", "gate_decision", "article_type_hint", "institutions", "pr_counter_signals", "matched_financial_terms", "matched_pr_terms", "reasons", "rules_version"]


def articles(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, None), (9002, "", "of the"), (9003, "of", "the"), (9004, "Bank’s 5% – (of-the) u.s. o'neil", "the.of, 5%x x5% a--b"), (9005, "\0 x", "in the  in\nthe")]
    return d.select("doc_id", F.substring_index("text", "\n", 1).alias("headline"), F.col("text").alias("article_text")).unionByName(spark.createDataFrame(odd, "doc_id long, headline string, article_text string"))


def same(spark, rules):
    a = articles(spark)
    want = scoring.score(a, rules).select("doc_id", *RESULTS)
    got = lexicon.score(a, lexicon.terms_of(spark, rules), rules.version).select("doc_id", *RESULTS)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(want)


def test_equals_the_plan_of_literals(spark):
    same(spark, DEMO)


def test_equals_it_for_203_terms_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "MAX_TERMS", 50)
    rng = random.Random(8)
    words = [w for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect() for w in r.text.split()[:60]]
    term = lambda: " ".join(rng.choices(words, k=rng.choice([1, 1, 2])))
    fixed = ["5%", "%", "u.s.", "o'neil", "of-the", "--", "5%x", "The", "the", " of  the ", "é", "x"]
    groups = lambda n, m: {f"g{i}": {"weight": rng.choice([1, 2.5, 7]), "max_score": 20 + i, "terms": [term() for _ in range(m)] + fixed[i :: n]} for i in range(n)}
    rules = Rules.of({"version": "t", "financial_relevance": groups(4, 25), "pr_noise": groups(3, 20), "pr_counter_signals": [term() for _ in range(12)] + ["of the", "5% the"], "institutions": {f"I{i}": {"aliases": [term(), term()]} for i in range(5)}})
    assert len(rules.terms()) >= 203
    same(spark, rules)


def test_fifty_thousand_terms(spark):
    """No literal of the plan; some texts by plain search."""
    rng = random.Random(9)
    a = articles(spark).limit(60)
    forms = {r.doc_id: (r.h, r.b) for r in a.select("doc_id", text.matching_form(F.col("headline")).alias("h"), text.matching_form(F.col("article_text")).alias("b")).collect()}
    words = sorted({w for h, b in forms.values() for w in b.split()})
    terms = sorted({" ".join(rng.choices(words, k=rng.choice([1, 2]))) for _ in range(20_000)} | {f"term {k} of no text" for k in range(50_000)})
    table = spark.createDataFrame([("financial", f"g{i % 7}", i % 7, i, t, 1.0, 30.0) for i, t in enumerate(terms)], lexicon.TERMS)
    got = {(r.key, r.form): (r.in_headline, r.in_body) for r in lexicon.matches(a, table).collect()}
    want = {}
    for key, (h, b) in forms.items():
        for t in terms:
            f = text.matching_form_of(t)
            if f and f in f"{h} {b}":
                inside = [bool(re.search(rf"(?<![a-z0-9]){re.escape(f)}(?![a-z0-9])", s)) for s in (h, b, f"{h} {b}")]
                if inside[2]:
                    want[key, f] = tuple(inside[:2])
    assert got == want
    assert lexicon.score(a, table, "v").count() == 60


def test_no_terms_and_no_articles(spark):
    none = spark.createDataFrame([], lexicon.TERMS)
    a = articles(spark).limit(3)
    assert [r.financial_score for r in lexicon.score(a, none, "v").collect()] == [0, 0, 0]
    assert lexicon.score(a.where("false"), lexicon.terms_of(spark, DEMO), "v").collect() == []
