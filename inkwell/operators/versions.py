"""Versions, change labels, latest records, sightings and the re-fetch chain."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def change_status(previous: Column, current: Column) -> Column:
    return F.when(previous.isNull(), "NEW").when(previous != current, "CHANGED").otherwise("UNCHANGED")


def with_changes(fetches: DataFrame, key: str, order: str | list[str], hash_col: str = "content_hash", before: DataFrame | None = None) -> DataFrame:
    """status against the key's fetch before, and the version that this gives.

    before: key, hash_before and version_before, one row a key: what went before
    the first of these fetches. Without it each key's first fetch is NEW.
    """
    w = W.partitionBy(key).orderBy(*([order] if isinstance(order, str) else order))
    if before is None:
        begun, previous, version = fetches, F.lag(hash_col).over(w), F.lit(0)
    else:
        begun = fetches.join(before, key, "left")
        previous, version = F.coalesce(F.lag(hash_col).over(w), F.col("hash_before")), F.coalesce("version_before", F.lit(0))
    labelled = begun.withColumn("status", change_status(previous, F.col(hash_col)))
    changed = (F.col("status") != "UNCHANGED").cast("long")
    counted = labelled.withColumn("version_number", version + F.sum(changed).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return counted.drop("hash_before", "version_before")


def latest(records: DataFrame, identity: list[str], version: str, modified: str, path: str) -> DataFrame:
    """The record of each identity with the highest version, then the newest, then the first path.

    Ranks prune within tasks before the shuffle, so a long history sends one
    row a task.
    """
    order = [F.coalesce(F.col(version).cast("long"), F.lit(0)).desc(), F.col(modified).desc_nulls_last(), F.col(path)]
    ranked = records.withColumn("_rank", F.row_number().over(W.partitionBy(*identity).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def seen_state(sightings: DataFrame, key: str, at: str, headline: str) -> DataFrame:
    """One row a key: first and last sighting, count and the last headline that isn't empty."""
    filled = F.when(F.coalesce(F.col(headline), F.lit("")) != "", F.col(at))
    return sightings.groupBy(key).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"), F.max_by(headline, filled).alias("headline"), F.count(F.lit(1)).alias("sightings"))


def merge_state(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old and new snapshots of seen_state as one: a full outer merge."""
    o, n = old.alias("o"), new.alias("n")
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(
        F.coalesce(f"o.{key}", f"n.{key}").alias(key),
        F.least("o.first_seen_at", "n.first_seen_at").alias("first_seen_at"),
        F.greatest("o.last_seen_at", "n.last_seen_at").alias("last_seen_at"),
        F.coalesce(F.nullif("n.headline", F.lit("")), F.col("o.headline")).alias("headline"),
        (F.coalesce("o.sightings", F.lit(0)) + F.coalesce("n.sightings", F.lit(0))).alias("sightings"),
    )


def update_after_fetch(state: DataFrame, fetched: DataFrame, key: str = "url") -> DataFrame:
    """State after a run: hash, time and, where changed, version come from `fetched` (one row a key)."""
    s, f = state.alias("s"), fetched.alias("f")
    changed = F.col(f"f.{key}").isNotNull() & ~F.col("s.content_hash").eqNullSafe(F.col("f.content_hash"))
    return s.join(f, F.col(f"s.{key}") == F.col(f"f.{key}"), "full").select(
        F.coalesce(f"s.{key}", f"f.{key}").alias(key),
        F.coalesce(F.col("f.content_hash"), F.col("s.content_hash")).alias("content_hash"),
        F.coalesce(F.col("f.last_fetched_at"), F.col("s.last_fetched_at")).alias("last_fetched_at"),
        (F.coalesce("s.version_number", F.lit(0)) + changed.cast("long")).alias("version_number"),
    )


def fetch_chain(sightings: DataFrame, key: str, at: str, hours: float, since: DataFrame | None = None) -> DataFrame:
    """key, at, fetched: a sighting fetches when the last fetch is `hours` old; skipped ones don't reset the clock.

    Ordered state that no window function holds. Rows are dealt and sorted by
    key and walked in a stream, so a key of any length needs no memory. Rows
    without key or time are left out. since: key and at of fetches that went
    before, one row a key; they open their keys' walks, and aren't returned.
    """
    gap = int(hours * 3600e6)
    kind = sightings.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = None, 0
        for batch in batches:
            done = []
            for k, t, new in zip(batch["k"].tolist(), batch["t"].tolist(), batch["new"].tolist(), strict=True):
                go = not new or k != held or t - last >= gap
                if go:
                    held, last = k, t
                done.append(go)
            yield batch[["k", "t"]].assign(fetched=done)[batch["new"]]

    def rows(df: DataFrame, new: bool) -> DataFrame:
        named = df.select(F.col(key).alias("k"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.lit(new).alias("new"))
        return named.where("k is not null and t is not null")

    todo = rows(sightings, True) if since is None else rows(since, False).unionByName(rows(sightings, True))
    walked = todo.repartition("k").sortWithinPartitions("k", "new", "t").mapInPandas(run, f"k {kind}, t long, fetched boolean")
    return walked.select(F.col("k").alias(key), F.timestamp_micros("t").alias(at), "fetched")
