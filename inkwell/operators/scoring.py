"""Rule scoring: weighted, capped term groups, institutions, gate and reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.sources.rules import STRONG_GROUPS, Group, Rules

HEADLINE_FINANCIAL, HEADLINE_PR = 1.5, 1.6
_GROUPS = "array<struct<name:string,terms:array<string>,score:double>>"

# Thresholds of labels and gate, bonus and penalty steps.
HIGH, MEDIUM, LIKELY_PR, POSSIBLE_PR, PR_BAR, STRONG_FINANCIAL, SUPERVISORY = 60, 35, 70, 40, 75, 70, 50


def matched_group(headline: Column, body: Column, g: Group, boost: float, words: tuple[Column | None, Column | None] = (None, None)) -> Column:
    """struct(name, terms, score): sorted distinct matches and their capped sum; words: the texts' word sets."""
    in_headline, in_body = (text.matching_terms(t, list(g.terms), w) for t, w in zip((headline, body), words, strict=True))
    both = F.struct(in_headline.alias("h"), F.array_sort(F.array_union(in_headline, in_body)).alias("all"))
    total = lambda m: F.aggregate(m["all"], F.lit(0.0), lambda s, t: s + F.lit(g.weight) * F.when(F.array_contains(m["h"], t), F.lit(boost)).otherwise(1.0))
    return F.element_at(F.transform(F.array(both), lambda m: F.struct(F.lit(g.name).alias("name"), m["all"].alias("terms"), F.least(total(m), F.lit(g.max_score)).alias("score"))), 1)


def matched_groups(headline: Column, body: Column, groups: tuple[Group, ...], boost: float, words: tuple[Column | None, Column | None] = (None, None)) -> Column:
    """The groups with a match, in the rules' order."""
    if not groups:
        return F.array().cast(_GROUPS)
    return F.filter(F.array(*[matched_group(headline, body, g, boost, words) for g in groups]), lambda g: F.size(g["terms"]) > 0)


def institutions(combined: Column, rules: Rules, words: Column | None = None) -> Column:
    """Sorted names of which an alias stands in the text."""
    if not rules.institutions:
        return text.literals([])
    named = [F.when(F.size(text.matching_terms(combined, list(aliases), words)) > 0, F.lit(name)) for name, aliases in rules.institutions]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*named))))


def financial_label(score: Column) -> Column:
    return F.when(score >= HIGH, "HIGH").when(score >= MEDIUM, "MEDIUM").otherwise("LOW")


def pr_label(score: Column) -> Column:
    return F.when(score >= LIKELY_PR, "LIKELY_PR").when(score >= POSSIBLE_PR, "POSSIBLE_PR").otherwise("LOW_PR_SIGNAL")


def financial_score(raw: Column, n_institutions: Column) -> Column:
    bonus = F.when(n_institutions > 0, F.least(18 + 4 * (n_institutions - 1), F.lit(30))).otherwise(0)
    return F.least(F.bround(raw + bonus).cast("int"), F.lit(100))


def pr_score(raw: Column, n_counter: Column, financial: Column) -> Column:
    less = F.when(n_counter > 0, F.least(F.lit(30), 12 + 4 * n_counter)).otherwise(0) + F.when(financial >= STRONG_FINANCIAL, 8).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.bround(raw - less).cast("int"), F.lit(100)))


def gate_decision(financial: Column, pr: Column, n_counter: Column, strong: Column) -> Column:
    noisy = (pr >= PR_BAR) & (n_counter == 0) & ~strong
    return F.when(financial >= HIGH, F.when(noisy, "WATCH").otherwise("INCLUDE_CANDIDATE")).when(financial >= MEDIUM, "WATCH").otherwise("EXCLUDE_NOISE")


def article_type_hint(financial: Column, pr: Column, n_counter: Column, strong: Column) -> Column:
    return (
        F.when((strong | (n_counter > 0)) & (financial >= SUPERVISORY), "SUPERVISORY_NEWS_CANDIDATE")
        .when(pr >= LIKELY_PR, "LIKELY_CORPORATE_PR")
        .when(pr >= POSSIBLE_PR, "POSSIBLE_CORPORATE_PR")
        .when(financial >= HIGH, "FINANCIAL_NEWS")
        .when(financial >= MEDIUM, "GENERAL_FINANCIAL")
        .otherwise("GENERAL_BUSINESS_OR_NOISE")
    )


def is_strong(groups: Column) -> Column:
    return F.arrays_overlap(F.transform(groups, lambda g: g["name"]), text.literals(list(STRONG_GROUPS)))


def reasons(names: Column, financial: Column, pr: Column, counter: Column) -> Column:
    """Sentences on what was found, in order; one sentence when nothing was."""
    line = lambda label: lambda g: F.concat(F.lit(f"{label} group '"), g["name"], F.lit("': "), F.array_join(g["terms"], ", "))
    when = lambda values, label: F.when(F.size(values) > 0, F.array(F.concat(F.lit(label), F.array_join(values, ", ")))).otherwise(text.literals([]))
    found = F.concat(when(names, "Financial institution detected: "), F.transform(financial, line("Financial")), F.transform(pr, line("PR/noise")), when(counter, "PR counter-signals: "))
    return F.when(F.size(found) > 0, found).otherwise(text.literals(["No significant financial, supervisory, institution, or promotional signals detected."]))


def score(articles: DataFrame, rules: Rules, headline: str = "headline", body: str = "article_text") -> DataFrame:
    """articles with the columns of the stage-1 result.

    One pass over each row: no join, no shuffle. Terms are literals of the
    plan, so their number is that of the rules file; operators.lexicon takes a
    table of them.
    """
    normed = articles.withColumns({"_h": text.matching_form(F.col(headline)), "_b": text.matching_form(F.col(body))})
    normed = normed.withColumns({"_hw": text.word_set(F.col("_h"), rules.terms()), "_bw": text.word_set(F.col("_b"), rules.terms()), "_c": F.concat("_h", F.lit(" "), "_b")})
    normed = normed.withColumn("_cw", F.array_union("_hw", "_bw"))
    h, b, words = F.col("_h"), F.col("_b"), (F.col("_hw"), F.col("_bw"))
    matched = normed.withColumns(
        {
            "_f": matched_groups(h, b, rules.financial, HEADLINE_FINANCIAL, words),
            "_p": matched_groups(h, b, rules.pr, HEADLINE_PR, words),
            "institutions": institutions(F.col("_c"), rules, F.col("_cw")),
            "pr_counter_signals": text.matching_terms(F.col("_c"), list(rules.counter), F.col("_cw")),
        }
    )
    return outcome(matched, rules.version).drop("_h", "_b", "_c", "_hw", "_bw", "_cw")


def outcome(matched: DataFrame, version: str) -> DataFrame:
    """matched (_f and _p: groups with a match; institutions, pr_counter_signals) with scores, labels, gate and reasons."""
    total = lambda groups: F.aggregate(groups, F.lit(0.0), lambda s, g: s + g["score"])
    n_counter = F.size("pr_counter_signals")
    scored = matched.withColumns({"financial_score": financial_score(total(F.col("_f")), F.size("institutions"))})
    scored = scored.withColumns({"pr_score": pr_score(total(F.col("_p")), n_counter, F.col("financial_score"))})
    f, p, strong = F.col("financial_score"), F.col("pr_score"), is_strong(F.col("_f"))
    named = lambda c: F.transform(c, lambda g: F.struct(g["name"].alias("name"), g["terms"].alias("terms")))
    return scored.withColumns(
        {
            "rules_version": F.lit(version),
            "financial_label": financial_label(f),
            "pr_label": pr_label(p),
            "gate_decision": gate_decision(f, p, n_counter, strong),
            "article_type_hint": article_type_hint(f, p, n_counter, strong),
            "matched_financial_terms": named(F.col("_f")),
            "matched_pr_terms": named(F.col("_p")),
            "reasons": reasons(F.col("institutions"), F.col("_f"), F.col("_p"), F.col("pr_counter_signals")),
        }
    ).drop("_f", "_p")


def required_fields_failure(headline: Column, body: Column, url: Column) -> Column:
    """The first required field that is empty, or null."""
    return F.when(text.is_blank(headline), "HEADLINE_MISSING").when(text.is_blank(body), "ARTICLE_TEXT_MISSING").when(text.is_blank(url), "SOURCE_URL_MISSING")
