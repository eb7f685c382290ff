"""Quality rules with cross-document line frequency, in DataFrame operations.

Every document is measured where it lies: words, their characters, symbols,
lines that repeat, and words in five-word windows that repeat. Its distinct
normalised lines leave as hashes that include the host (the source). A line
that stands in MOST of its host's documents, or in more than SHARE of them and
in LEAST at least, is removed everywhere on that host; a document that keeps
less than REMAINS of its words, or fails the base rules, is rejected.

Windows and lines are compared by 64-bit hashes. Rows are named by a number
that the written measurements hold, so ids may repeat. Counting folds within
tasks first; lines above the limits are a MOST-th of all lines at most, or few
(1 / SHARE times the mean number of lines a document, for each host), and Spark
picks the join by their size.

Defined cases: a null text has no words and no lines, fails the base rules and
is not kept; documents without source share one host; each row counts as a
document; lines without words are nobody's; an empty table gives no rows; extra
columns are ignored; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import BLANKS, NOT_BLANKS, only
from inkwell.session import materialize, table

#: A line is removed where MOST of the host's documents hold it; in small hosts already where more than SHARE hold it, LEAST at least.
MOST, SHARE, LEAST = 20, 0.1, 8
#: Share of its words that a kept document keeps.
REMAINS = 0.5
#: Base rules: fewest words; most words, as a percentage, in repeated windows.
FEWEST, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that stand in a WINDOW-word window found twice or more.

    Equal windows stand together after a sort by hash; the starts of all of
    them, sorted, cover their words up to the next start.
    """

    def of_hashes(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(by_hash, of_sorted))

    def of_sorted(s: Column) -> Column:
        twins = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
        return let(F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull())))), of_starts)

    def of_starts(p: Column) -> Column:
        own = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0), lambda total, x: total + x)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(hashes, of_hashes))


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), BLANKS, " "))


def measured(d: DataFrame) -> DataFrame:
    """doc_id, host, the base measures and the document's lines: struct(line, words)."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({NOT_BLANKS})"), F.lit(1))
    counted = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))

    def of_lines(ls: Column) -> Column:
        hashed = F.transform(ls, lambda x: F.struct(F.xxhash64(F.lit("line"), "host", normalised_line(x)).alias("line"), F.regexp_count(x, F.lit(NOT_BLANKS)).cast("long").alias("words")))
        return F.struct((F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"), hashed.alias("lines"))

    with_words = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    return d.select(
        "doc_id",
        "host",
        counted.alias("c"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(with_words, of_lines).alias("l"),
    ).select("doc_id", "host", "c.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words", "l.lines")


def frequent_lines(m: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST) -> DataFrame:
    """line, documents: the lines that too many documents of their host hold."""
    hosts = m.groupBy("host").agg(F.count(F.lit(1)).alias("in_host"))
    held = m.select("host", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    often = held.groupBy("line").agg(F.count(F.lit(1)).alias("documents"), F.first("host").alias("line_host")).where(F.col("documents") >= min(least, most))
    return often.join(hosts, F.col("line_host").eqNullSafe(F.col("host"))).where((F.col("documents") >= most) | (F.col("documents") >= least) & (F.col("documents") > share * F.col("in_host"))).select("line", "documents")


def apply_rules(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, remains: float = REMAINS, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a document: the base measures, base_failed, n_removed_words and kept."""
    d = only(docs, doc_id=id_col, host=host_col, text=text_col)
    m = materialize(measured(d).withColumn("row", F.monotonically_increasing_id()), "measured")
    often = materialize(frequent_lines(m, share, least, most), "frequent")
    each = m.select("row", F.explode("lines").alias("l")).select("row", "l.line", "l.words")
    removed = each.join(often, "line").groupBy("row").agg(F.sum("words").alias("n_removed_words"))
    n, gone = F.col("n_words"), F.coalesce("n_removed_words", F.lit(0))
    failed = (n < FEWEST) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    return m.join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), gone.alias("n_removed_words"), (~failed & (n - gone >= remains * n)).alias("kept")
    )


def without_frequent_lines(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, text: every document's text less the lines above the limit."""
    d = only(docs, doc_id=id_col, host=host_col, text=text_col)
    numbered = materialize(d.withColumn("row", F.monotonically_increasing_id()), "numbered")
    m = measured(numbered).select("host", "lines")
    often = materialize(frequent_lines(m, share, least, most), "frequent")
    lines = numbered.select("row", "host", F.posexplode(F.split("text", "\n")).alias("at", "l"))
    keyed = lines.withColumn("line", F.when(F.length(F.translate("l", " \t\n\x0b\x0c\r", "")) > 0, F.xxhash64(F.lit("line"), "host", normalised_line(F.col("l")))))
    left = keyed.join(often, "line", "left_anti").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "l"))).alias("ls"))
    return numbered.join(left, "row", "left").select("doc_id", F.when(F.col("text").isNotNull(), F.coalesce(F.array_join("ls.l", "\n"), F.lit(""))).alias("text"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 5) x(k) GROUP BY r),
l AS (
  SELECT r, source, x, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT r, source, unnest(ls) AS x FROM w)),
often AS (
  SELECT source, line FROM (SELECT source, line, count(DISTINCT r) AS n FROM l GROUP BY source, line)
  JOIN (SELECT source AS s, count(*) AS docs FROM d GROUP BY source) ON source IS NOT DISTINCT FROM s
  WHERE n >= 20 OR n >= 8 AND n > 0.1::DOUBLE * docs),
gone AS (
  SELECT l.r, sum(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))::BIGINT AS n
  FROM l JOIN often o ON l.line = o.line AND l.source IS NOT DISTINCT FROM o.source GROUP BY l.r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN rep ON w.r = rep.r LEFT JOIN gone ON w.r = gone.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_removed_words,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_removed_words >= 0.5::DOUBLE * n_words AS kept
FROM m
"""
