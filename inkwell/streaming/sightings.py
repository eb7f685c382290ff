"""Structured Streaming forms of the state operators.

Batches of sightings arrive as files or from a log. The re-fetch gate is state
by key: the time of the last fetch, which a skipped sighting doesn't reset.
Version state is the content hash and the version by URL. Both are foreachBatch
functions and run under Trigger.AvailableNow for scheduled runs or continuously.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.versions import fetch_chain, with_changes

LAST = "key string, at timestamp"
FETCHED = "key string, at timestamp, fetched boolean"
VERSIONED = "key string, at timestamp, content_hash string, status string, version_number long"
HELD = "key string, hash_before string, version_before long"


def gate_each(folder: str, key: str, at: str, hours: float = 6.0) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the gate's rows of a batch go to folder/out/batch=N, each key's last fetch to folder/state-0 or -1.

    A batch reads the state that the one before wrote and leaves it alone, so a
    batch that comes again after a failure gives the same rows once more.
    Sightings without key or time are left out.
    """

    def each(batch: DataFrame, number: int) -> None:
        read = batch.sparkSession.read
        named = batch.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"))
        before = read.schema(LAST).parquet(f"{folder}/state-{(number - 1) % 2}") if number else None
        to = f"{folder}/out/batch={number}"
        fetch_chain(named, "key", "at", hours, before).write.mode("overwrite").parquet(to)
        fetched = read.schema(FETCHED).parquet(to).where("fetched").select("key", "at")
        known = fetched if before is None else fetched.unionByName(before)
        known.groupBy("key").agg(F.max("at").alias("at")).write.mode("overwrite").parquet(f"{folder}/state-{number % 2}")

    return each


def versions_each(folder: str, key: str, at: str, hash_col: str = "content_hash") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: change status and version number of a batch's fetches go to folder/out/batch=N, each key's last hash and version to folder/state-0 or -1.

    The batch's fetches of a key are ranked in order of time by Spark and begin
    with what the batch before left, so no key is held whole; as in gate_each, a
    batch that comes again gives the same rows once more. Fetches without key or
    time are left out.
    """

    def each(batch: DataFrame, number: int) -> None:
        read = batch.sparkSession.read
        named = batch.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(hash_col).alias("content_hash")).where("key is not null and at is not null")
        held = read.schema(HELD).parquet(f"{folder}/state-{(number - 1) % 2}") if number else None
        to = f"{folder}/out/batch={number}"
        with_changes(named, "key", ["at", "content_hash"], before=held).write.mode("overwrite").parquet(to)
        last = read.schema(VERSIONED).parquet(to).groupBy("key").agg(F.max_by(F.struct("content_hash", "version_number"), F.struct("at", "content_hash")).alias("l"))
        state = last.select("key", F.col("l.content_hash").alias("hash_before"), F.col("l.version_number").alias("version_before"))
        if held is not None:
            state = state.unionByName(held.join(state.select("key"), "key", "left_anti"))
        state.write.mode("overwrite").parquet(f"{folder}/state-{number % 2}")

    return each


def seen_counts(sightings: DataFrame, key: str, at: str, late: str = "1 day", every: str = "1 hour") -> DataFrame:
    """Sightings by key and window; rows later than the watermark are left out by Spark."""
    return sightings.withWatermark(at, late).groupBy(F.window(at, every), key).agg(F.count(F.lit(1)).alias("sightings"))


def into_state(load: Callable[[], DataFrame], save: Callable[[DataFrame, int], None], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges each batch into a stored state.

    save gets the batch's number: a batch that comes again after a failure must
    overwrite what it wrote before.
    """

    def each(batch: DataFrame, number: int) -> None:
        save(merge(load(), batch), number)

    return each
