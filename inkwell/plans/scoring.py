"""Queries of the rule-scoring chain over documents, with the demo rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import lexicon, rollup, scoring, selection
from inkwell.session import materialize, table
from inkwell.sources.rules import DEMO, STRONG_GROUPS, Group, Rules


def scored(spark, sf_dir: str, rules: Rules = DEMO) -> DataFrame:
    """documents as articles (the first line is the headline) with the stage-1 columns."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_name"), F.substring_index("text", "\n", 1).alias("headline"), F.col("text").alias("article_text"))
    return scoring.score(d, rules)


def term_match(spark, sf_dir):
    body = text.matching_form(F.col("text"))
    terms = [t for g in DEMO.financial + DEMO.pr for t in g.terms]
    d = table(spark, sf_dir, "documents").select("doc_id", body.alias("form"))
    return d.select("doc_id", F.array_join(F.array_sort(text.matching_terms(F.col("form"), terms)), "|").alias("terms"))


def group_score(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.matching_form(F.substring_index("text", "\n", 1)).alias("h"), text.matching_form(F.col("text")).alias("b"))
    each = d.select("doc_id", F.explode(scoring.matched_groups(F.col("h"), F.col("b"), DEMO.financial, scoring.HEADLINE_FINANCIAL)).alias("g"))
    return each.select("doc_id", F.col("g.name").alias("group_name"), F.array_join("g.terms", "|").alias("terms"), "g.score")


def institution_detect(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", text.list_text(F.col("institutions")).alias("institutions"), text.list_text(F.col("pr_counter_signals")).alias("counter_signals"))


def gate_decision(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "financial_score", "financial_label", "pr_score", "pr_label", "gate_decision", "article_type_hint")


def reasons_text(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("doc_id", F.array_join("reasons", " / ").alias("reasons"), text.groups_text(F.col("matched_pr_terms")).alias("pr_terms"))


def gate_counts(spark, sf_dir):
    return rollup.gate_counts(scored(spark, sf_dir), ["source_name"])


def review_merge(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    given = labels.select(F.col("doc_id").cast("string").alias("source_url"), F.when(F.col("quality") == 1, "RELEVANT").otherwise("").alias("human_label"), F.concat(F.lit("toxic="), F.col("toxic")).alias("review_notes"), "toxic")
    review = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_url"), F.lit(None).cast("string").alias("human_label"), F.lit(None).cast("string").alias("review_notes"))
    return selection.merge_annotations(review, selection.last_annotations(given, "toxic")).select("doc_id", "human_label", "review_notes")


def stage1_full(spark, sf_dir):
    """The whole chain: required fields, scores, labels, gate, terms, and the human labels given before."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"), F.when(F.col("quality") == 1, "RELEVANT").otherwise("NOT_RELEVANT").alias("given")).distinct()
    s = scored(spark, sf_dir)
    failure = scoring.required_fields_failure(F.col("headline"), F.col("article_text"), F.col("doc_id").cast("string"))
    kept = s.withColumn("failure", failure).where("failure is null")
    rows = kept.select(
        "doc_id", "source_name", "financial_score", "financial_label", "pr_score", "pr_label", "article_type_hint", "gate_decision",
        text.list_text(F.col("institutions")).alias("institutions"),
        text.groups_text(F.col("matched_financial_terms")).alias("matched_financial_terms"),
        text.groups_text(F.col("matched_pr_terms")).alias("matched_pr_terms"),
        text.list_text(F.col("pr_counter_signals")).alias("pr_counter_signals"),
    )
    return rows.join(labels, F.col("doc_id") == F.col("labelled"), "left").drop("labelled").withColumn("human_label", F.coalesce("given", F.lit(""))).drop("given")


def lexicon_groups(spark, sf_dir):
    """Documents scored with a table of terms: all words, and pairs of words, of the benchmark's texts, in groups by length."""
    b = table(spark, sf_dir, "benchmark").select(text.matching_form(F.col("text")).alias("form")).withColumn("chunks", F.split("form", " "))
    pairs = F.zip_with("chunks", F.slice("chunks", F.lit(2), F.size("chunks")), lambda x, y: F.concat(F.regexp_extract(x, "([a-z0-9]+)$", 1), F.lit(" "), F.regexp_extract(F.coalesce(y, F.lit("")), "^([a-z0-9]+)", 1)))
    two = F.filter(pairs, lambda t: t.rlike("^[a-z0-9]+ [a-z0-9]+$"))
    words = b.select(F.explode(F.concat(F.regexp_extract_all("form", F.lit("([a-z0-9]+)"), F.lit(1)), two)).alias("term")).distinct()
    n = F.length("term")
    terms = words.select(F.lit("financial").alias("kind"), F.concat(F.lit("g"), n % 5).alias("group"), (n % 5).cast("int").alias("group_ord"), F.lit(0).alias("term_ord"), "term", (1 + n % 3).cast("double").alias("weight"), F.lit(25.0).alias("max_score"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("headline"), F.col("text").alias("article_text"))
    held = materialize(terms, "terms")
    return lexicon.group_rows(lexicon.matches(d, held), held).select(F.col("key").alias("doc_id"), "group", F.size("terms").cast("long").alias("n_terms"), F.sha2(F.array_join("terms", "|"), 256).alias("terms_sha256"), "score")


QUERIES = {f.__name__: f for f in (term_match, group_score, lexicon_groups, institution_detect, gate_decision, reasons_text, gate_counts, review_merge, stage1_full)}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(kind: str, groups: tuple[Group, ...], boost: float) -> list[str]:
    return [f"({_q(kind)}, {_q(g.name)}, {i}, {_q(t)}, {g.weight}::DOUBLE, {g.max_score}::DOUBLE, {boost}::DOUBLE)" for i, g in enumerate(groups) for t in g.terms]


_FORM = r"trim(regexp_replace(regexp_replace(translate(lower({0}), '’‘–—', '''''--'), '[^a-z0-9%+\-''. ]+', ' ', 'g'), ' +', ' ', 'g'))"
_HAS = "regexp_matches({0}, '(^|[^a-z0-9])' || {1} || '([^a-z0-9]|$)')"


def oracle(rules: Rules) -> str:
    """The chain in SQL: terms as a table, joined to every text."""
    terms = ", ".join(_values("financial", rules.financial, scoring.HEADLINE_FINANCIAL) + _values("pr", rules.pr, scoring.HEADLINE_PR))
    aliases = ", ".join(f"({_q(n)}, {_q(a)})" for n, held in rules.institutions for a in held)
    counter = ", ".join(f"({i}, {_q(t)})" for i, t in enumerate(rules.counter))
    strong = ", ".join(_q(g) for g in STRONG_GROUPS)
    return f"""
d AS (SELECT doc_id, source AS source_name, text, {_FORM.format("split_part(text, chr(10), 1)")} AS h, {_FORM.format("text")} AS b FROM documents),
terms(kind, grp, ord, term, weight, cap, boost) AS (VALUES {terms}),
hits AS (SELECT doc_id, t.*, {_HAS.format("h", "term")} AS in_h FROM d, terms t WHERE {_HAS.format("h", "term")} OR {_HAS.format("b", "term")}),
groups AS (
  SELECT doc_id, kind, grp, ord, string_agg(term, '|' ORDER BY term) AS terms, string_agg(term, ', ' ORDER BY term) AS said,
         least(sum(weight * CASE WHEN in_h THEN boost ELSE 1 END), max(cap)) AS score
  FROM hits GROUP BY ALL),
inst AS (
  SELECT doc_id, string_agg(name, '; ' ORDER BY name) AS institutions, string_agg(name, ', ' ORDER BY name) AS said, count(*) AS n
  FROM (SELECT DISTINCT doc_id, name FROM d, (VALUES {aliases}) a(name, alias) WHERE {_HAS.format("h || ' ' || b", "alias")}) GROUP BY doc_id),
cnt AS (
  SELECT doc_id, string_agg(term, '; ' ORDER BY ord) AS counter_signals, string_agg(term, ', ' ORDER BY ord) AS said, count(*) AS n
  FROM d, (VALUES {counter}) c(ord, term) WHERE {_HAS.format("h || ' ' || b", "term")} GROUP BY doc_id),
fin AS (
  SELECT doc_id, sum(score) AS raw, string_agg(grp || ':' || terms, '; ' ORDER BY ord) AS terms, bool_or(grp IN ({strong})) AS strong,
         string_agg('Financial group ''' || grp || ''': ' || said, ' / ' ORDER BY ord) AS said
  FROM groups WHERE kind = 'financial' GROUP BY doc_id),
pr AS (
  SELECT doc_id, sum(score) AS raw, string_agg(grp || ':' || terms, '; ' ORDER BY ord) AS terms,
         string_agg('PR/noise group ''' || grp || ''': ' || said, ' / ' ORDER BY ord) AS said
  FROM groups WHERE kind = 'pr' GROUP BY doc_id),
one AS (
  SELECT d.doc_id, d.source_name, d.text, coalesce(i.institutions, '') AS institutions, coalesce(c.counter_signals, '') AS counter_signals, coalesce(c.n, 0) AS nc,
         coalesce(f.terms, '') AS fin_terms, coalesce(p.terms, '') AS pr_terms, coalesce(f.strong, false) AS strong,
         coalesce(nullif(concat_ws(' / ', 'Financial institution detected: ' || i.said, f.said, p.said, 'PR counter-signals: ' || c.said), ''),
                  'No significant financial, supervisory, institution, or promotional signals detected.') AS reasons,
         least(round_even(coalesce(f.raw, 0) + CASE WHEN i.n > 0 THEN least(18 + 4 * (i.n - 1), 30) ELSE 0 END, 0)::INTEGER, 100) AS financial_score,
         coalesce(p.raw, 0) AS pr_raw
  FROM d LEFT JOIN inst i USING (doc_id) LEFT JOIN cnt c USING (doc_id) LEFT JOIN fin f USING (doc_id) LEFT JOIN pr p USING (doc_id)),
two AS (
  SELECT *, greatest(0, least(round_even(pr_raw - CASE WHEN nc > 0 THEN least(30, 12 + 4 * nc) ELSE 0 END - CASE WHEN financial_score >= 70 THEN 8 ELSE 0 END, 0)::INTEGER, 100)) AS pr_score
  FROM one),
s AS (
  SELECT *, CASE WHEN financial_score >= 60 THEN 'HIGH' WHEN financial_score >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS financial_label,
         CASE WHEN pr_score >= 70 THEN 'LIKELY_PR' WHEN pr_score >= 40 THEN 'POSSIBLE_PR' ELSE 'LOW_PR_SIGNAL' END AS pr_label,
         CASE WHEN financial_score >= 60 THEN CASE WHEN pr_score >= 75 AND nc = 0 AND NOT strong THEN 'WATCH' ELSE 'INCLUDE_CANDIDATE' END
              WHEN financial_score >= 35 THEN 'WATCH' ELSE 'EXCLUDE_NOISE' END AS gate_decision,
         CASE WHEN (strong OR nc > 0) AND financial_score >= 50 THEN 'SUPERVISORY_NEWS_CANDIDATE' WHEN pr_score >= 70 THEN 'LIKELY_CORPORATE_PR'
              WHEN pr_score >= 40 THEN 'POSSIBLE_CORPORATE_PR' WHEN financial_score >= 60 THEN 'FINANCIAL_NEWS' WHEN financial_score >= 35 THEN 'GENERAL_FINANCIAL'
              ELSE 'GENERAL_BUSINESS_OR_NOISE' END AS article_type_hint
  FROM two)"""


_CHAIN = "WITH " + oracle(DEMO)

_FORM = r"trim(regexp_replace(regexp_replace(translate(lower({}), '’‘–—', '''''--'), '[^a-z0-9%+\-''. ]+', ' ', 'g'), ' +', ' ', 'g'))"
_WORDS_AND_PAIRS = r"""list_concat(regexp_extract_all(f, '[a-z0-9]+'), list_filter(list_transform(list_zip(c, c[2:]),
         lambda x: regexp_extract(x[1], '[a-z0-9]+$') || ' ' || regexp_extract(coalesce(x[2], ''), '^[a-z0-9]+')), lambda x: regexp_matches(x, '^[a-z0-9]+ [a-z0-9]+$')))"""

ORACLES = {
    "lexicon_groups": f"""
WITH t AS (SELECT DISTINCT unnest({_WORDS_AND_PAIRS}) AS term FROM (SELECT f, string_split(f, ' ') AS c FROM (SELECT {_FORM.format("text")} AS f FROM benchmark))),
d AS (
  SELECT doc_id, head, f, string_split(f, ' ') AS c
  FROM (SELECT doc_id, true AS head, {_FORM.format("split_part(text, chr(10), 1)")} AS f FROM documents UNION ALL SELECT doc_id, false, {_FORM.format("text")} FROM documents)),
m AS (SELECT doc_id, term, bool_or(head) AS head FROM (SELECT doc_id, head, unnest({_WORDS_AND_PAIRS}) AS term FROM d) JOIN t USING (term) GROUP BY doc_id, term)
SELECT doc_id, 'g' || length(term) % 5 AS "group", count(*) AS n_terms, sha256(string_agg(term, '|' ORDER BY term)) AS terms_sha256,
       least(sum((1 + length(term) % 3)::DOUBLE * CASE WHEN head THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END), 25.0::DOUBLE) AS score
FROM m GROUP BY 1, 2""",
    "term_match": _CHAIN + f"""
SELECT d.doc_id, coalesce(string_agg(term, '|' ORDER BY term), '') AS terms FROM d LEFT JOIN terms ON {_HAS.format("b", "term")} GROUP BY d.doc_id""",
    "group_score": _CHAIN + " SELECT doc_id, grp AS group_name, terms, score FROM groups WHERE kind = 'financial'",
    "institution_detect": _CHAIN + " SELECT doc_id, institutions, counter_signals FROM s",
    "gate_decision": _CHAIN + " SELECT doc_id, financial_score, financial_label, pr_score, pr_label, gate_decision, article_type_hint FROM s",
    "reasons_text": _CHAIN + " SELECT doc_id, reasons, pr_terms FROM s",
    "gate_counts": _CHAIN + """
SELECT source_name, count(*) FILTER (gate_decision = 'INCLUDE_CANDIDATE') AS include, count(*) FILTER (gate_decision = 'WATCH') AS watch,
       count(*) FILTER (gate_decision = 'EXCLUDE_NOISE') AS exclude, count(*) FILTER (gate_decision IS NULL) AS failed
FROM s GROUP BY source_name""",
    "review_merge": """
WITH l AS (SELECT doc_id, arg_max(CASE WHEN quality = 1 THEN 'RELEVANT' ELSE '' END, toxic) AS human_label, arg_max('toxic=' || toxic, toxic) AS review_notes FROM labels GROUP BY doc_id)
SELECT d.doc_id, coalesce(human_label, '') AS human_label, coalesce(review_notes, '') AS review_notes FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id""",
    "stage1_full": _CHAIN + r"""
SELECT s.doc_id, source_name, financial_score, financial_label, pr_score, pr_label, article_type_hint, gate_decision, institutions,
       fin_terms AS matched_financial_terms, pr_terms AS matched_pr_terms, counter_signals AS pr_counter_signals, coalesce(given, '') AS human_label
FROM s LEFT JOIN (SELECT DISTINCT doc_id, CASE WHEN quality = 1 THEN 'RELEVANT' ELSE 'NOT_RELEVANT' END AS given FROM labels) l ON s.doc_id = l.doc_id
WHERE regexp_matches(split_part(text, chr(10), 1), '\S')""",
}
