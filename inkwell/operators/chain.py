"""The re-fetch chain of keys that are too long for one task.

Whether a sighting fetches depends on the last fetch, so a chain looks serial.
But what a block of time does to it is a function: a last fetch before the block
gives the last fetch within it. Only sightings of a block's first `gap`, and one
more, can be its first fetch, so the function is a short table of pieces:

- upward, rows are dealt by key and block, and each task walks all possible
  entries of its blocks at once (entries that meet go on as one). Blocks are
  composed to longer blocks in the same way, WIDTH at a time, LEVELS times;
- the longest blocks of a key, few by then, are walked one after another;
- downward, each block learns the last fetch before it and hands it to its
  parts, until rows are marked.

Every pass is a stream over sorted rows that holds at most the distinct times
of one key within one gap. Results equal `versions.fetch_chain`.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.versions import fetch_chain
from inkwell.session import materialize, ship

#: Gaps in a block, and blocks in a longer block.
WIDTH = 8
#: Times that blocks are composed.
LEVELS = 3
#: Sightings from which a key is cut into blocks.
HOT_ROWS = 1_000_000
#: The last fetch of a key that had none, in microseconds.
NEVER = -(2**62)


class Entries:
    """All possible entries of a block, and the last fetch to which each has led so far.

    An entry takes the thresholds (last fetch + gap) up to its end and beyond
    the end before. Heads are (last fetch, runs of entries), in order of time.
    """

    def __init__(self, start: int, gap: int):
        self.gap, self.until = gap, start + gap
        self.ends: list[int] = []
        self.heads: deque[tuple[int, list[list[int]]]] = deque()
        self.part, self.moved = None, {}

    def settle(self) -> None:
        self.heads.extend(sorted(self.moved.items()))
        self.moved = {}

    def add(self, part: int, upto: int, last: int) -> None:
        """A piece of the next part: thresholds up to `upto`, beyond the piece before, lead to `last`."""
        if part != self.part:
            self.settle()
            self.part = part
        while self.heads and self.heads[0][0] + self.gap <= upto:
            self.join(last, self.heads.popleft()[1])
        if not self.ends or self.ends[-1] < self.until:
            self.join(last, [[len(self.ends)] * 2])
            self.ends.append(upto)

    def join(self, last: int, runs: list[list[int]]) -> None:
        held = self.moved.setdefault(last, [])
        for run in runs:
            if held and held[-1][1] + 1 == run[0]:
                held[-1][1] = run[1]
            else:
                held.append(run)

    def pieces(self) -> list[tuple[int, int]]:
        self.settle()
        return [(self.ends[run[1]], last) for last, runs in self.heads for run in runs]


def _composed(parts: DataFrame, span: int, gap: int) -> DataFrame:
    """Pieces of blocks of `span` from pieces of their parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, entries = None, None
        for batch in batches:
            done = []
            for k, block, part, upto, last in zip(*[batch[c].tolist() for c in ("k", "block", "part", "upto", "last")], strict=True):
                if (k, block) != held:
                    if held is not None:
                        done += [(*held, *p) for p in entries.pieces()]
                    held, entries = (k, block), Entries(block, gap)
                entries.add(part, upto, last)
            yield pd.DataFrame(done, columns=["k", "part", "upto", "last"])
        if held is not None:
            yield pd.DataFrame([(*held, *p) for p in entries.pieces()], columns=["k", "part", "upto", "last"])

    dealt = parts.withColumn("block", _start(F.col("part"), span)).repartition("k", "block").sortWithinPartitions("k", "block", "part", "upto")
    return dealt.mapInPandas(run, f"k {parts.schema['k'].dataType.simpleString()}, part long, upto long, last long")


def _start(at: Column, span: int) -> Column:
    return at - F.pmod(at, F.lit(span))


def _opened(parts: DataFrame, openings: DataFrame, block: Column, gap: int) -> DataFrame:
    """k, block, last: the last fetch before each part, from the last fetch before its block (openings: k, block, last)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last, part, after = None, NEVER, None, None
        for batch in batches:
            done = []
            for k, b, opens, p, upto, to in zip(*[batch[c].tolist() for c in ("k", "block", "opens", "part", "upto", "last")], strict=True):
                if (k, b) != held:
                    held, last, part, after = (k, b), NEVER, None, None
                if opens:
                    last = to
                    continue
                if p != part:
                    last = last if after is None else after
                    part, after = p, None
                    done.append((k, p, last))
                if after is None and upto >= last + gap:
                    after = to
            yield pd.DataFrame(done, columns=["k", "block", "last"])

    rows = parts.select("k", block.alias("block"), F.lit(False).alias("opens"), "part", "upto", "last")
    opening = openings.select("k", "block", F.lit(True).alias("opens"), F.lit(NEVER).alias("part"), F.lit(NEVER).alias("upto"), "last")
    dealt = opening.unionByName(rows).repartition("k", "block").sortWithinPartitions("k", "block", F.desc("opens"), "part", "upto")
    return dealt.mapInPandas(run, f"k {parts.schema['k'].dataType.simpleString()}, block long, last long")


def _marked(times: DataFrame, openings: DataFrame, span: int, gap: int) -> DataFrame:
    """k, t, fetched of every row, block by block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = None, NEVER
        for batch in batches:
            done = []
            for k, block, opens, t in zip(*[batch[c].tolist() for c in ("k", "block", "opens", "t")], strict=True):
                if (k, block) != held:
                    held, last = (k, block), NEVER
                go = opens or t - last >= gap
                last = t if go else last
                done.append(go)
            yield batch[["k", "t"]].assign(fetched=done)[~batch["opens"]]

    rows = times.select("k", _start(F.col("t"), span).alias("block"), F.lit(False).alias("opens"), "t")
    opening = openings.select("k", "block", F.lit(True).alias("opens"), F.col("last").alias("t"))
    dealt = opening.unionByName(rows).repartition("k", "block").sortWithinPartitions("k", "block", F.desc("opens"), "t")
    return dealt.mapInPandas(run, f"k {times.schema['k'].dataType.simpleString()}, t long, fetched boolean")


def fetch_chain_in_blocks(sightings: DataFrame, key: str, at: str, hours: float, since: DataFrame | None = None, width: int = WIDTH, levels: int = LEVELS) -> DataFrame:
    """key, at, fetched as `fetch_chain` gives them, with each key's time cut into blocks that different tasks walk.

    Rows without key or time are left out; equal times of a key fetch once;
    since: key and at of the fetches that went before, one row a key and no
    later than its sightings; an empty table gives no rows.
    """
    ship(sightings.sparkSession)
    gap = int(hours * 3600e6)

    def micros(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("k"), F.unix_micros(F.col(at).cast("timestamp")).alias("t")).where("k is not null and t is not null")

    times = micros(sightings)
    spans = [max(gap, 1) * width**n for n in range(1, levels + 1)]
    parts, steps = times.select("k", F.col("t").alias("part"), F.col("t").alias("upto"), F.col("t").alias("last")), []
    for span in spans:
        parts = materialize(_composed(parts, span, gap), "blocks")
        steps.append(parts)
    whole = F.lit(0).cast("long")
    begun = times.sparkSession.createDataFrame([], parts.select("k", "last").schema) if since is None else micros(since).withColumnRenamed("t", "last")
    openings = _opened(steps[-1], begun.withColumn("block", whole), whole, gap)
    for step, span in zip(steps[-2::-1], spans[:0:-1], strict=True):
        openings = _opened(step, openings, _start(F.col("part"), span), gap)
    marked = _marked(times, openings, spans[0], gap)
    return marked.select(F.col("k").alias(key), F.timestamp_micros("t").alias(at), "fetched")


def fetch_chain_of_all(sightings: DataFrame, key: str, at: str, hours: float, since: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As `fetch_chain`; keys of more than hot_rows sightings go by blocks, all others in one walk each."""
    counts = sightings.groupBy(key).agg(F.count(at).alias("rows")).where(F.col("rows") > hot_rows)
    hot = materialize(counts.select(key), "hot-keys")

    def of(df: DataFrame | None, how: str) -> DataFrame | None:
        return None if df is None else df.join(hot, key, how)

    usual = fetch_chain(of(sightings, "left_anti"), key, at, hours, of(since, "left_anti"))
    return usual.unionByName(fetch_chain_in_blocks(of(sightings, "left_semi"), key, at, hours, of(since, "left_semi")))
