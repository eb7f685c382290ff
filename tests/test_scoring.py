"""Scores, labels and the gate against plain Python and worked examples."""

import json

import pytest
from pyspark.sql import functions as F

from inkwell.functions.text import matching_form_of
from inkwell.operators import scoring
from inkwell.sources.rules import DEMO, STRONG_GROUPS, Rules, load_registry, load_rules

# Weight and cap of the stock groups.
FINANCIAL = {"banking_core": (7, 35), "supervisory_risk": (14, 56), "prudential_regulatory": (12, 48), "governance": (10, 40), "financial_performance": (7, 35), "transactions_structure": (8, 32)}
PR = {"strong_promotional": (15, 45), "routine_business": (7, 28)}


def stock(terms):
    groups = lambda part: {g: {"weight": w, "max_score": m, "terms": terms.get(g, [])} for g, (w, m) in part.items()}
    return Rules.of({"version": "t", "financial_relevance": groups(FINANCIAL), "pr_noise": groups(PR), "pr_counter_signals": ["liquidity"], "institutions": {"Central Bank": {"aliases": ["central bank of x"]}, "Trust": {"aliases": ["trust bank"]}}})


TERMS = {"banking_core": ["bank", "banking", "lending", "finance company"], "governance": ["ceo", "chairman", "governance"], "prudential_regulatory": ["central bank", "central bank of x"], "financial_performance": ["assets"], "transactions_structure": ["acquisition"], "strong_promotional": ["recognised as", "recognition"], "routine_business": ["partnership"]}
CASES = [
    # headline, body, financial, pr, gate, hint
    ("Stake crosses 10%", "a finance company with assets after an acquisition", 22, 0, "EXCLUDE_NOISE", "GENERAL_BUSINESS_OR_NOISE"),
    ("Losses", "banking", 7, 0, "EXCLUDE_NOISE", "GENERAL_BUSINESS_OR_NOISE"),
    ("Market subdued", "the central bank of x, liquidity and bank lending", 56, 0, "WATCH", "SUPERVISORY_NEWS_CANDIDATE"),
    ("Awards", "trust bank, banking, recognised as, recognition, partnership", 32, 37, "EXCLUDE_NOISE", "GENERAL_BUSINESS_OR_NOISE"),
    ("Bank", "x", 10, 0, "EXCLUDE_NOISE", "GENERAL_BUSINESS_OR_NOISE"),  # 7 * 1.5 = 10.5, half to even
    ("", "", 0, 0, "EXCLUDE_NOISE", "GENERAL_BUSINESS_OR_NOISE"),
]


def test_worked_examples(spark):
    rows = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i int, headline string, article_text string")
    got = {r.i: (r.financial_score, r.pr_score, r.gate_decision, r.article_type_hint) for r in scoring.score(rows, stock(TERMS)).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[2:] for c in CASES]


def plain(headline, body, rules):
    h, b = f" {matching_form_of(headline)} ", f" {matching_form_of(body)} "

    def has(s, t):
        at = s.find(t)
        while at >= 0:
            if not (s[at - 1].isascii() and s[at - 1].isalnum()) and not (s[at + len(t)].isascii() and s[at + len(t)].isalnum()):
                return True
            at = s.find(t, at + 1)
        return False

    def total(groups, boost):
        score, found = 0.0, {}
        for g in groups:
            in_h = {t for t in g.terms if has(h, t)}
            both = sorted(in_h | {t for t in g.terms if has(b, t)})
            if both:
                score += min(sum(g.weight * (boost if t in in_h else 1) for t in both), g.max_score)
                found[g.name] = both
        return score, found

    whole = h[:-1] + b
    f, fin = total(rules.financial, 1.5)
    names = sorted(n for n, held in rules.institutions if any(has(whole, a) for a in held))
    f = min(round(f + (min(18 + 4 * (len(names) - 1), 30) if names else 0)), 100)
    counter = [t for t in rules.counter if has(whole, t)]
    p, pr = total(rules.pr, 1.6)
    p = max(0, min(round(p - (min(30, 12 + 4 * len(counter)) if counter else 0) - (8 if f >= 70 else 0)), 100))
    strong = bool(set(fin) & set(STRONG_GROUPS))
    gate = ("WATCH" if p >= 75 and not counter and not strong else "INCLUDE_CANDIDATE") if f >= 60 else "WATCH" if f >= 35 else "EXCLUDE_NOISE"
    return f, p, gate, names, counter, fin, pr


def test_demo_rules_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "substring_index(text, '\n', 1) headline", "text article_text")
    for r in scoring.score(docs, DEMO).collect():
        said = lambda groups: {g.name: list(g.terms) for g in groups}
        assert plain(r.headline, r.article_text, DEMO) == (r.financial_score, r.pr_score, r.gate_decision, r.institutions, r.pr_counter_signals, said(r.matched_financial_terms), said(r.matched_pr_terms))


@pytest.mark.parametrize("score, financial, pr", [(34, "LOW", "LOW_PR_SIGNAL"), (35, "MEDIUM", "LOW_PR_SIGNAL"), (39, "MEDIUM", "LOW_PR_SIGNAL"), (40, "MEDIUM", "POSSIBLE_PR"), (59, "MEDIUM", "POSSIBLE_PR"), (60, "HIGH", "POSSIBLE_PR"), (69, "HIGH", "POSSIBLE_PR"), (70, "HIGH", "LIKELY_PR")])
def test_labels_at_their_bounds(spark, score, financial, pr):
    s = F.lit(score)
    assert tuple(spark.range(1).select(scoring.financial_label(s), scoring.pr_label(s)).first()) == (financial, pr)


@pytest.mark.parametrize("f, p, counter, strong, gate", [(60, 75, 0, False, "WATCH"), (60, 74, 0, False, "INCLUDE_CANDIDATE"), (60, 75, 1, False, "INCLUDE_CANDIDATE"), (60, 75, 0, True, "INCLUDE_CANDIDATE"), (59, 0, 0, False, "WATCH"), (34, 99, 0, True, "EXCLUDE_NOISE")])
def test_gate(spark, f, p, counter, strong, gate):
    assert spark.range(1).select(scoring.gate_decision(F.lit(f), F.lit(p), F.lit(counter), F.lit(strong))).first()[0] == gate


@pytest.mark.parametrize("raw, want", [(10.5, 10), (11.5, 12), (34.5, 34), (59.5, 60), (69.5, 70), (127.5, 100)])
def test_rounding_is_half_to_even(spark, raw, want):
    assert spark.range(1).select(scoring.financial_score(F.lit(raw), F.lit(0))).first()[0] == want


def test_reasons_have_a_default(spark):
    r = scoring.score(spark.createDataFrame([("", None)], "headline string, article_text string"), DEMO).first()
    assert r.reasons == ["No significant financial, supervisory, institution, or promotional signals detected."]


def test_files_of_rules_and_sources(spark, tmp_path):
    held = {"version": 2, "financial_relevance": {"g": {"weight": 1, "max_score": 2, "terms": ["a"]}}}
    (tmp_path / "r.json").write_text("\ufeff" + json.dumps(held), encoding="utf-8")
    rules = load_rules(tmp_path / "r.json")
    assert (rules.version, rules.financial[0].terms, rules.pr) == ("2", ("a",), ())
    assert rules.terms_table(spark).count() == 1
    (tmp_path / "s.json").write_text(json.dumps({"sources": {"k": {"name": "N", "enabled": True}}}))
    assert load_registry(spark, tmp_path / "s.json").first().name == "N"
    (tmp_path / "bad.json").write_text("[]")
    with pytest.raises(ValueError):
        load_rules(tmp_path / "bad.json")
    with pytest.raises(FileNotFoundError):
        load_rules(tmp_path / "none.json")
