"""Scoring with a table of terms: a lexicon of any size, and no term in the plan.

The terms' matching forms travel to the tasks in parts of bounded size; a task
builds one automaton of a part and walks each text through it once, whatever the
number of terms. What it finds are rows, and Spark joins them with the table and
folds them to groups, institutions and signals. Texts never move.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import scoring
from inkwell.session import materialize, ship
from inkwell.sources.rules import Rules

#: Terms of one part; more are searched for in several passes.
MAX_TERMS = 200_000
TERMS = "kind string, group string, group_ord int, term_ord int, term string, weight double, max_score double"
_FOUND = pa.schema([("key", pa.int64()), ("form", pa.string()), ("in_headline", pa.bool_()), ("in_body", pa.bool_())])
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_built: dict = {}


def terms_of(spark: SparkSession, rules: Rules) -> DataFrame:
    """A rules file as a table (TERMS): kinds financial, pr, counter and institution (its aliases)."""
    more = [("counter", "", 0, j, t, 0.0, 0.0) for j, t in enumerate(rules.counter)] + [("institution", name, i, j, a, 0.0, 0.0) for i, (name, aliases) in enumerate(rules.institutions) for j, a in enumerate(aliases)]
    return rules.terms_table(spark).unionByName(spark.createDataFrame(more, TERMS))


def automaton(forms: Broadcast):
    """The automaton of a part, built once in a worker; it holds one."""
    import ahocorasick

    if _built.get("of") is not forms.value:
        a = ahocorasick.Automaton()
        for f in forms.value:
            a.add_word(f, f)
        a.make_automaton()
        _built.clear()
        _built.update(of=forms.value, automaton=a)
    return _built["automaton"]


def standing(words, said: str, headline: int) -> dict[str, tuple[bool, bool]]:
    """The forms that stand alone in a text, and whether they do in its first `headline` characters and after these."""
    found: dict[str, tuple[bool, bool]] = {}
    for end, form in words.iter(said):
        start = end - len(form) + 1
        if (start and said[start - 1] in _LETTERS) or (end + 1 < len(said) and said[end + 1] in _LETTERS):
            continue
        a, b = found.get(form, (False, False))
        found[form] = (a or end < headline, b or start > headline)
    return found


def matches(articles: DataFrame, terms: DataFrame, key: str = "doc_id", headline: str = "headline", body: str = "article_text") -> DataFrame:
    """key, form, in_headline, in_body: the distinct forms of terms that stand in each article.

    A form that neither the headline nor the body holds, but both together,
    has neither. key: a long that names the article.
    """
    spark = articles.sparkSession
    ship(spark)
    forms = materialize(terms.select(text.matching_form(F.col("term")).alias("form")).where("form <> ''").distinct(), "forms")
    n = forms.count()
    h, b = text.matching_form(F.col(headline)), text.matching_form(F.col(body))
    said = articles.select(F.col(key).cast("long").alias("key"), h.alias("h"), b.alias("b"))

    def searched(part: Broadcast) -> DataFrame:
        def run(batches):
            words = automaton(part)
            for batch in batches:
                keys, out = batch.column(0).to_pylist(), {f.name: [] for f in _FOUND}
                for k, x, y in zip(keys, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    got = standing(words, f"{x} {y}", len(x))
                    out["key"] += [k] * len(got)
                    out["form"] += got
                    out["in_headline"] += [a for a, _ in got.values()]
                    out["in_body"] += [c for _, c in got.values()]
                yield pa.RecordBatch.from_pydict(out, schema=_FOUND)

        return said.mapInArrow(run, "key long, form string, in_headline boolean, in_body boolean")

    parts = max(1, -(-n // MAX_TERMS))
    found = spark.createDataFrame([], "key long, form string, in_headline boolean, in_body boolean")
    for i in range(parts if n else 0):
        mine = [r["form"] for r in forms.where(F.pmod(F.xxhash64("form"), F.lit(parts)) == i).collect()]  # about MAX_TERMS
        if mine:
            found = found.unionByName(searched(spark.sparkContext.broadcast(sorted(mine))))
    return materialize(found, "term_matches")


def group_rows(found: DataFrame, terms: DataFrame) -> DataFrame:
    """key, kind, group, group_ord, terms (sorted), score: each article's groups of weighted terms, capped."""
    weighted = terms.where("kind in ('financial', 'pr')").dropDuplicates(["kind", "group", "term"]).withColumn("form", text.matching_form(F.col("term")))
    boost = F.when(F.col("kind") == "financial", scoring.HEADLINE_FINANCIAL).otherwise(scoring.HEADLINE_PR)
    worth = F.col("weight") * F.when(F.col("in_headline"), boost).otherwise(1.0)
    each = found.where("in_headline or in_body").join(weighted, "form").select("key", "kind", "group", "group_ord", "max_score", F.struct("term", worth.alias("worth")).alias("t"))
    held = each.groupBy("key", "kind", "group", "group_ord").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.max("max_score").alias("most"))
    total = F.aggregate("ts", F.lit(0.0), lambda s, t: s + t["worth"])
    return held.select("key", "kind", "group", "group_ord", F.transform("ts", lambda t: t["term"]).alias("terms"), F.least(total, F.col("most")).alias("score"))


def score(articles: DataFrame, terms: DataFrame, version: str, key: str = "doc_id", headline: str = "headline", body: str = "article_text") -> DataFrame:
    """key and the columns of scoring.score, one row an article; the same results as its plan of literals."""
    found = matches(articles, terms, key, headline, body)
    rows = group_rows(found, terms)
    listed = F.array_sort(F.collect_list(F.struct("group_ord", F.struct(F.col("group").alias("name"), "terms", "score").alias("g"))))
    groups = rows.groupBy("key", "kind").agg(F.transform(listed, lambda x: x["g"]).alias("gs"))
    of_kind = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("gs")))
    by_key = groups.groupBy("key").agg(of_kind("financial").alias("_f"), of_kind("pr").alias("_p"))
    named = found.join(terms.where("kind in ('institution', 'counter')").withColumn("form", text.matching_form(F.col("term"))), "form")
    signals = F.array_sort(F.collect_list(F.when(F.col("kind") == "counter", F.struct("term_ord", "term"))))
    names = F.array_sort(F.collect_set(F.when(F.col("kind") == "institution", F.col("group"))))
    said = named.groupBy("key").agg(names.alias("institutions"), F.array_distinct(F.transform(signals, lambda s: s["term"])).alias("pr_counter_signals"))
    keys = articles.select(F.col(key).cast("long").alias("key"))
    none, no_groups = F.array().cast("array<string>"), F.array().cast(scoring._GROUPS)
    whole = keys.join(by_key, "key", "left").join(said, "key", "left").select(
        F.col("key").alias(key), *[F.coalesce(c, no_groups).alias(c) for c in ("_f", "_p")], *[F.coalesce(c, none).alias(c) for c in ("institutions", "pr_counter_signals")]
    )
    return scoring.outcome(whole, version)
