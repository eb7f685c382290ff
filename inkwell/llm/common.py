"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkwell.session import materialize

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"
BLANK_BYTES = b" \t\n\v\f\r"

#: Bytes of UTF-8 lower-cased for A-Z alone; all that is neither a-z, 0-9 nor part of a longer code point is a blank.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
#: A-Z lower-cased, the rest as it is.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Longest run of rows that a Python worker holds as objects at once, and most bytes of their texts (a single text may exceed it).
ROWS, BYTES = 512, 4 << 20
#: 64-bit words of a Bloom filter at most (1 MB), and the seeds of its two hashes.
MAX_WORDS = 1 << 17
SEEDS = (7, 11)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names: clashing or extra columns go."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def named_rows(df: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """df with a long that names each row, and its column.

    Ids that are whole, never null and never repeat name the rows themselves,
    and df stays where it lies; only ids move to find that out. Otherwise rows
    get numbers, written with df, so that they stay the same.
    """
    ids = df.select(F.col(f"`{id_col}`").alias("id"))
    if ids.schema["id"].dataType == LongType() and ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").isEmpty():
        return df, id_col
    return numbered(df)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """df with a number for each row, and the number's column; written, so that it stays the same."""
    name, taken = "_row", {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def without_rows(rows: DataFrame, row: str, gone: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of the rows whose names aren't in gone."""
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in columns])


def place(doc_id: Column, row: Column) -> Column:
    """What decides which of several copies stays: the smallest id, nulls last, then the row's number."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), row.alias("row"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents from which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def texts(batches: Iterator[pa.RecordBatch], column: str = "text", rows: int | None = None) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of each batch, bounded in rows (ROWS, if not told) and bytes, with the texts as bytes (None for null)."""
    for batch in batches:
        whole = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(whole), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES, "right"))
            to = min(at + (rows or ROWS), max(fit, at + 1))
            yield batch.slice(at, to - at), whole.slice(at, to - at).to_pylist()
            at = to


def out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def filter_of(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """A Bloom filter of a column: one row with an array of 64-bit words.

    16 bits a key, MAX_WORDS words (1 MB) at most: the bound holds at any
    input. A full filter lets more rows pass, never fewer.
    """
    n = keys.count()
    words = 64
    while words < MAX_WORDS and words * 4 < n:
        words *= 2
    spots = keys.select(F.explode(F.array(*[_spot(F.col(column), seed, words) for seed in SEEDS])).alias("spot")).groupBy("spot.word").agg(F.bit_or("spot.bit").alias("bits"))
    dense = keys.sparkSession.range(words).withColumnRenamed("id", "word").join(spots, "word", "left")
    rows = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return dense.agg(F.transform(rows, lambda x: x["bits"]).alias("words")), words


def _spot(key: Column, seed: int, words: int) -> Column:
    h = F.xxhash64(key, F.lit(seed))
    return F.struct(F.pmod(h, F.lit(words)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")).alias("bit"))


def may_hold(key: Column, held: DataFrame, words: int) -> Column:
    """False only where the filter tells that the key isn't in it."""
    array = held.scalar()
    tests = []
    for seed in SEEDS:
        spot = _spot(key, seed, words)
        tests.append(F.get(array, spot["word"].cast("int")).bitwiseAND(spot["bit"]) != 0)
    return tests[0] & tests[1]
