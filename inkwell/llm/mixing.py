"""Mixing sources to target weights, in DataFrame operations.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
share 150 % of all words by weight. A target stops at twice its source's size;
what is over goes to the others by weight until none is above.

Sampling (Efraimidis-Spirakis): each document draws u from its id, its text and
the seed and gets the exponential key -ln(u) / w, where w is its quality weight;
small keys come first. A source's complete epochs take every document; then the
fractional part takes documents in key order while their prefix sum comes no
further from the budget than stopping would.

Prefix sums are hierarchical: keys fall into buckets of about 128 documents,
buckets into super-buckets of 1,024. Each window sees one of these groups, so a
source of a third of all rows is spread over many tasks. Buckets are cut by the
distribution of keys under the source's own weights, so they are even whatever
the weights are; rows that repeat an id, or have none, spread by their texts.
Only the table of targets, one row a source, is one task's.

Defined cases: a null text has no words; documents without words are never
taken more often than their source's epochs and count 0; equal keys are ordered
by id, size and the text's hash, so reruns agree however rows are dealt (rows
that agree in all of these are interchangeable); a null weight counts as the
middle weight, one under LEAST_WEIGHT as that; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.llm.common import NOT_BLANKS, named_rows, only
from inkwell.session import materialize, table

#: Documents a bucket, buckets a super-bucket.
BUCKET, SUPER = 128, 1024
#: Weight of a document of quality 0 and 1, and where the quality is not known.
LOW, HIGH, MIDDLE = 0.5, 2.0, 1.0
LEAST_WEIGHT = 1e-6
SHARE_NUM, SHARE_DEN, MOST = 3, 2, 2
SOURCE_WEIGHTS = (3, 1, 2)
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANKS)), F.lit(0)).cast("long")


def hexadecimal(digits: Column, n: int) -> Column:
    return F.conv(F.substring(digits, 1, n), 16, 10).cast("long")


def draw(doc_id: Column, text_hash: Column, seed: str) -> Column:
    """A number in (0, 1) that follows from id, text and seed alone."""
    digits = hexadecimal(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), text_hash, F.lit(seed))), 12)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, n -> with target, one row a source.

    A source is full when the words that the fuller ones leave would give it
    more than twice its size. With sources in the order of size / weight, the
    full ones come first, so running sums over one row a source decide it.
    """
    everything = W.partitionBy(F.lit(1))
    by_name = W.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    fullest = W.partitionBy(F.lit(1)).orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(W.unboundedPreceding, -1)
    rank = (F.row_number().over(by_name) - 1) % len(SOURCE_WEIGHTS)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in SOURCE_WEIGHTS]), (rank + 1).cast("int")).cast("long"))
    summed = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
    )
    # in halves of a word, all sums are whole numbers
    share = summed.withColumn("left2", F.col("all_size") * (2 * SHARE_NUM // SHARE_DEN) - F.col("size_before") * (2 * MOST))
    full = F.col("left2") * F.col("weight") >= F.col("source_size") * (2 * MOST) * F.col("weight_left")
    marked = share.withColumn("full", full)
    first_open = F.max(F.when(~F.col("full"), F.struct("weight_left", "left2"))).over(everything)
    told = marked.withColumn("open", first_open)
    return told.select(
        "source",
        "source_size",
        "n",
        F.when(F.col("full"), F.col("source_size").cast("double") * MOST).otherwise(F.col("open.left2").cast("double") * F.col("weight") / (F.col("open.weight_left") * 2)).alias("target"),
    )


def mix(docs: DataFrame, weights: DataFrame | None = None, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: doc_id, size, source_size, target, epochs, copies, taken.

    weights: doc_id, weight, one row an id; ids that it lacks weigh MIDDLE.
    """
    d = only(docs, doc_id=id_col, source=source_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    return _mixed(d, weights, seed).drop("row")


def _mixed(d: DataFrame, weights: DataFrame | None, seed: str) -> DataFrame:
    """mix() of row, doc_id, source, text, with the row."""
    hashed = F.md5(F.coalesce("text", F.lit("")))
    d = d.select("row", "doc_id", "source", n_words(F.col("text")).alias("size"), hashed.alias("hash"))
    if weights is not None:
        w = weights.select(F.col("doc_id").alias("_id"), F.col("weight").cast("double"))
        d = d.join(w, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    else:
        d = d.withColumn("weight", F.lit(MIDDLE))
    weight = F.greatest(F.coalesce("weight", F.lit(MIDDLE)), F.lit(LEAST_WEIGHT))
    key = -F.log(draw(F.col("doc_id"), F.col("hash"), seed)) / weight
    sized = materialize(d.select("row", "doc_id", "source", "size", hexadecimal(F.col("hash"), 15).alias("tie"), weight.alias("weight"), key.alias("key")), "sized")
    goals = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))).join(_weight_classes(sized), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "targets")

    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    joined = sized.alias("a").join(goals.alias("b"), same, "left").select("a.*", "source_size", "n", "target", "classes")
    # the share of the source's keys that are expected above this one
    above = F.aggregate("classes", F.lit(0.0), lambda total, c: total + c["share"] * F.exp(-c["weight"] * F.col("key")))
    buckets = F.ceil(F.col("n") / BUCKET)
    bucket = F.greatest(F.lit(0), F.least(buckets - 1, F.floor((1 - above) * buckets))).cast("long")
    spread = joined.withColumn("bucket", bucket).withColumn("super", F.floor(F.col("bucket") / SUPER).cast("long")).drop("classes")

    sums = spread.groupBy("source", "super", "bucket").agg(F.sum("size").alias("s"))
    tops = sums.groupBy("source", "super").agg(F.sum("s").alias("s"))
    over = W.partitionBy("source").orderBy("super").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select("source", "super", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("top_before"))
    inside = W.partitionBy("source", "super").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("source", "super", "bucket", F.coalesce(F.sum("s").over(inside), F.lit(0)).alias("before"))
    starts = sums.alias("x").join(tops.alias("y"), F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.super") == F.col("y.super"))).select("x.source", "x.bucket", (F.col("before") + F.col("top_before")).alias("start"))

    order = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "tie", "row").rowsBetween(W.unboundedPreceding, -1)
    local = spread.withColumn("own", F.coalesce(F.sum("size").over(order), F.lit(0)))
    placed = local.alias("x").join(starts.alias("y"), F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.bucket") == F.col("y.bucket"))).select("x.*", (F.col("own") + F.col("start")).alias("prefix"))

    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("size") > 0) & (F.col("prefix") * 2 + F.col("size") <= budget * 2)
    return placed.withColumn("epochs", epochs).withColumn("copies", F.col("epochs") + extra.cast("long")).select("row", "doc_id", "size", "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _weight_classes(sized: DataFrame) -> DataFrame:
    """_source, classes: at most 65 classes of weights, half an octave wide, with their mean and share."""
    octave = F.greatest(F.lit(-32), F.least(F.lit(32), F.round(F.log2("weight") * 2))).cast("int")
    counted = sized.groupBy(F.col("source").alias("_source"), octave.alias("octave")).agg(F.avg("weight").alias("weight"), F.count(F.lit(1)).alias("m"))
    listed = counted.groupBy("_source").agg(F.array_sort(F.collect_list(F.struct("octave", "weight", "m"))).alias("held"), F.sum("m").alias("all"))
    return listed.select("_source", F.transform("held", lambda c: F.struct(c["weight"].alias("weight"), (c["m"] / F.col("all")).alias("share"))).alias("classes"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight: between LOW and HIGH by the mean quality label of an id."""
    weight = F.lit(LOW) + F.avg("quality") * (HIGH - LOW)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(weight.alias("weight"))


def mixed_rows(docs: DataFrame, weights: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with docs' columns."""
    rows, row = named_rows(docs)
    m = _mixed(only(rows, row=row, doc_id="doc_id", source="source", text="text"), weights, seed).where("copies > 0")
    taken = materialize(m.select(F.col("row").alias("_taken"), F.array_repeat(F.lit(0), F.col("copies").cast("int")).alias("_copies")), "taken")
    joined = rows.join(taken, rows[row] == taken["_taken"])
    copy = "_copy"
    while copy.lower() in {c.lower() for c in docs.columns}:
        copy += "_"
    return joined.select(*[rows[f"`{c}`"] for c in docs.columns], F.explode(taken["_copies"]).alias(copy)).drop(copy)


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))


OP3_SQL = r"""
WITH q AS (SELECT doc_id, 0.5::DOUBLE + avg(quality) * 1.5::DOUBLE AS weight FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS tie,
         -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || md5(coalesce(text, '')) || 'mix'), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
           / coalesce(weight, 1.0::DOUBLE) AS key
  FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s),
c AS (
  SELECT *, 3 * (sum(source_size) OVER ()) - 4 * coalesce(sum(source_size) OVER before, 0) AS left2,
         (sum(w) OVER ()) - coalesce(sum(w) OVER before, 0) AS w_left
  FROM r
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, left2 * w >= 4 * source_size * w_left AS is_full FROM c),
o AS (SELECT max_by(left2, w_left) AS left2, max(w_left) AS w_left FROM f WHERE NOT is_full),
t AS (
  SELECT f.source, f.source_size,
         CASE WHEN is_full THEN f.source_size::DOUBLE * 2 ELSE o.left2::DOUBLE * f.w / (o.w_left * 2)::DOUBLE END AS target
  FROM f LEFT JOIN o ON true),
p AS (
  SELECT d.doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, size, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, epochs + CASE WHEN size > 0 AND prefix * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END AS copies FROM p)
SELECT doc_id, size, source_size, target, epochs, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM e
"""
