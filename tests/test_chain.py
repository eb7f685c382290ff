"""The re-fetch chain by blocks: against a loop, against the walk, and how it is dealt."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from inkwell.operators import chain, versions

START = datetime(2026, 1, 1)


def loop(rows, hours, since=()):
    want, last = [], dict(since)
    for k, t in sorted(r for r in rows if None not in r):
        go = k not in last or t - last[k] >= timedelta(hours=hours)
        if go:
            last[k] = t
        want.append((k, t, go))
    return sorted(want)


def answers(df):
    return sorted((r.k, r.t, r.fetched) for r in df.collect())


def test_entries_against_a_loop():
    """Each threshold that can enter a block leaves it as a loop over the block's times does, over two levels too."""
    rng = random.Random(8)
    for trial in range(300):
        gap = rng.choice([1, 5, 30])
        times = sorted(rng.sample(range(-200, 200), rng.choice([1, 3, 40, 200])))
        inner, blocks = [], {}
        for t in times:
            blocks.setdefault(t - t % (2 * gap), chain.Entries(t - t % (2 * gap), gap)).add(t, t, t)
        for start, entries in sorted(blocks.items()):
            inner += [(start, upto, last) for upto, last in sorted(entries.pieces())]
        start = -200 - gap
        start = min(start - start % (2 * gap), times[0])
        outer = chain.Entries(start, gap)
        for piece in inner:
            outer.add(*piece)
        table = sorted(outer.pieces())
        for before in range(start - gap - 3, start):
            last = before
            for t in times:
                last = t if t - last >= gap else last
            got = next((to for upto, to in table if upto >= before + gap), before)
            assert got == last, (trial, before)


@pytest.mark.parametrize("minutes, count", [(400, 350), (6000, 400), (90000, 300), (900000, 200)])
def test_blocks_against_a_loop(spark, minutes, count):
    rng = random.Random(minutes)
    rows = [(k, START + timedelta(minutes=rng.randrange(minutes), microseconds=rng.randrange(2))) for k in (1, 2) for _ in range(count)]
    rows += [(3, START), (3, START), (3, START + timedelta(hours=6)), (4, datetime(1969, 12, 31, 23)), (4, datetime(1970, 1, 1, 5)), (5, None), (None, START)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    assert answers(chain.fetch_chain_in_blocks(df, "k", "t", 6.0, width=3)) == loop(rows, 6)


def test_a_periodic_key_whose_chains_never_meet(spark):
    rows = [("a", START + timedelta(minutes=7 * i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    assert answers(chain.fetch_chain_in_blocks(df, "k", "t", 6.0, width=2, levels=4)) == loop(rows, 6)
    assert answers(chain.fetch_chain_in_blocks(df, "k", "t", 0.0, width=2)) == loop(rows, 0)


def test_fetches_before_open_the_chain(spark):
    rng = random.Random(3)
    rows = [(k, START + timedelta(minutes=rng.randrange(4000))) for k in (1, 2, 3) for _ in range(150)]
    since = [(1, START - timedelta(hours=5)), (2, START - timedelta(days=90)), (9, START)]
    df, before = spark.createDataFrame(rows, "k int, t timestamp"), spark.createDataFrame(since, "k int, t timestamp")
    want = loop(rows, 6, since)
    assert answers(chain.fetch_chain_in_blocks(df, "k", "t", 6.0, before)) == want
    assert answers(versions.fetch_chain(df, "k", "t", 6.0, before)) == want
    assert answers(chain.fetch_chain_of_all(df.where("k < 3 or t < '2026-01-02'"), "k", "t", 6.0, before, hot_rows=100)) == loop([r for r in rows if r[0] < 3 or r[1] < datetime(2026, 1, 2)], 6, since)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, t timestamp, k2 string")
    assert chain.fetch_chain_of_all(df, "k", "t", 6.0).collect() == []


def test_one_key_is_walked_by_many_tasks(spark):
    """A key over 200 days: its rows lie in 100 blocks, and the walk over the whole key sees few pieces."""
    times = spark.range(60000).select(F.lit(1).alias("k"), (F.col("id") * 288_000_000).alias("t"))
    gap = 6 * 3_600_000_000
    parts, sizes = times.select("k", F.col("t").alias("part"), F.col("t").alias("upto"), F.col("t").alias("last")), []
    for level in (1, 2, 3):
        if level == 1:
            per = parts.groupBy(chain._start(F.col("part"), gap * 8)).count()
            assert per.count() >= 100 and per.agg(F.max("count")).first()[0] <= 8 * 75
        parts = chain._composed(parts, gap * 8**level, gap)
        sizes.append(parts.count())
    assert sizes[0] <= 60000 / 8 + 200 and sizes[1] <= sizes[0] / 6 and sizes[2] <= sizes[1] / 4
