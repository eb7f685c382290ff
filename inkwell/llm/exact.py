"""Exact dedup by a log-structured merge index, in DataFrame operations.

1. Log: every row is digested where it lies; its number, id and digest are
   written. No text moves.
2. Memtables and runs: the log's tasks are dealt to RUNS runs. A task folds its
   equal digests to the least place and a count before anything leaves it; a run
   merges its tasks and is written sorted by digest, with Parquet's page bounds
   and Bloom filters. A digest of a third of all rows arrives as one row a task.
3. Compaction: the runs merge to one sorted index; of equal digests the smallest
   identifier stays, and counts add up.
4. Lookup: each row of the log finds its digest among those that several rows
   hold. `lookup` asks runs or index for a few digests, and reads what their
   filters cannot rule out.
5. Byte verification: the digests of several rows make a Bloom filter that rules
   out most other rows where they lie. The whole bytes of what is left, hits all
   of them, are compared: a task folds equal ones, and one text of each moves.
   Where a digest stands for several texts, its rows are grouped by their bytes.

Defined cases: null counts as empty, so nulls and empty texts are one group;
texts are equal when identical after each run of blanks became one space; of
equal texts the row with the smallest id stays, null ids last, of equal ids the
first row, so exactly one row of a group is kept, and kept is never null;
keep_id is null where the row that stays has no id; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import BLANKS, filter_of, may_hold, named_rows, only, place, without_rows
from inkwell.session import materialize, shared_dir, table

#: Runs that the log's tasks are dealt to.
RUNS = 16
#: Distinct digests that a file's Bloom filter expects.
PER_FILTER = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest_of(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _sorted_table(df: DataFrame, name: str) -> DataFrame:
    """df in the shared folder, each file sorted by digest, with Bloom filters."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkwell/{name}-{uuid.uuid4().hex}"
    by = [c for c in ("run", "digest") if c in df.columns]
    (
        df.sortWithinPartitions(*by)
        .write.option("parquet.bloom.filter.enabled#digest", "true")
        .option("parquet.bloom.filter.expected.ndv#digest", str(PER_FILTER))
        .parquet(path)
    )
    return spark.read.schema(df.schema).parquet(path)


def write_log(d: DataFrame) -> DataFrame:
    """row, doc_id, digest, run of every row of row, doc_id, text."""
    run = F.spark_partition_id() % RUNS
    return materialize(_digested(d).select("row", "doc_id", "digest", run.alias("run")), "log")


def _digested(d: DataFrame) -> DataFrame:
    """row, doc_id, norm, digest."""
    norm = d.select("row", "doc_id", normalised(F.col("text")).alias("norm"))
    return norm.withColumn("digest", digest_of(F.col("norm")))


def _folded(entries: DataFrame, *keys: str) -> DataFrame:
    """Entries of equal keys as one: the least place and all rows."""
    return entries.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.min("first").alias("first"))


def flush_runs(log: DataFrame) -> DataFrame:
    """The runs: one row a run and digest."""
    entries = log.select("run", "digest", place(F.col("doc_id"), F.col("row")).alias("first"), F.lit(1).cast("long").alias("rows"))
    return _sorted_table(_folded(entries, "run", "digest"), "runs")


def compact(runs: DataFrame) -> DataFrame:
    """The index: one row a digest, with the least place and the number of rows."""
    return _sorted_table(_folded(runs, "digest"), "index")


def lookup(entries: DataFrame, digests: list[bytes]) -> DataFrame:
    """The entries of a few digests: bounds and filters of the files rule out what can't hold them."""
    return entries.where(F.col("digest").isin(*[bytearray(d) for d in digests]))


def _decided(d: DataFrame) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, digest of every row of row, doc_id, text."""
    log = write_log(d)
    index = compact(flush_runs(log))
    # written, so that the join's sides are plain exchanges and Spark may split a hot digest
    several = materialize(index.where("rows > 1"), "several")
    found = _said(log.join(several.select("digest", "first", "rows"), "digest", "left"))
    odd = _unlike(d, several)
    return found if odd.isEmpty() else found.join(odd, "digest", "left_anti").unionByName(_by_bytes(d, odd))


def _said(rows: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("first.row") == F.col("row"), F.lit(True))
    keep_id = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.id"))
    return rows.select("row", "doc_id", keep_id.alias("keep_id"), F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), "digest")


def _unlike(d: DataFrame, several: DataFrame) -> DataFrame:
    """The digests of several under which whole texts differ: each hit is compared byte for byte."""
    held, words = filter_of(several, "digest")
    hits = _digested(d).select("digest", "norm").where(may_hold(F.col("digest"), held, words))
    counted = hits.distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
    return materialize(counted.where("texts > 1").select("digest"), "unlike")


def _by_bytes(d: DataFrame, odd: DataFrame) -> DataFrame:
    """The rows of digests that stand for several texts, decided by their whole texts."""
    mine = materialize(_digested(d).join(odd, "digest", "left_semi"), "odd")
    groups = mine.groupBy("norm").agg(F.min(place(F.col("doc_id"), F.col("row"))).alias("first"), F.count(F.lit(1)).alias("rows"))
    return _said(mine.join(groups, "norm"))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    d = only(docs, doc_id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    return _decided(d).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each text, with docs' columns: the row that `dedup_exact` keeps."""
    rows, row = named_rows(docs, id_col)
    gone = _decided(only(rows, row=row, doc_id=id_col, text=text_col)).where("not kept").select(F.col("row").alias(row))
    return without_rows(rows, row, gone, docs.columns)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_exact(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, text_sha256
FROM t
"""
