"""Points in ranges of any width, as an equi-join on dyadic cells: all pairs, or what each range holds.

A range of whole numbers falls into disjoint cells [k * 2^l, (k + 1) * 2^l), two
a level at most; a point lies in one cell a level. So each point meets a range
in exactly one cell: no doubles arise, no width is assumed, and Spark joins by
hash or sort, splitting hot cells as it does for any key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import materialize

#: Levels at most: ranges of up to 2^LEVELS are covered.
LEVELS = 40


def cells(low: Column, high: Column) -> Column:
    """array<struct<level, cell>>: the disjoint cells of the range low..high, both inside; none where high < low."""
    none = F.array().cast("array<struct<level:int,cell:bigint>>")
    start = F.struct(low.cast("long").alias("a"), high.cast("long").alias("b"), none.alias("out"))

    def step(s: Column, level: Column) -> Column:
        a, b = s["a"], s["b"]
        cell = lambda k: F.array(F.struct(level.alias("level"), k.alias("cell")))
        odd, even = (a <= b) & (F.pmod(a, F.lit(2)) == 1), (a <= b) & (F.pmod(b, F.lit(2)) == 0)
        # one cell that is both ends' is named once
        left, right = F.when(odd, cell(a)).otherwise(none), F.when(even & ~(odd & (a == b)), cell(b)).otherwise(none)
        up_a, up_b = a + odd.cast("long"), b - even.cast("long")
        return F.struct(
            F.when(up_a <= up_b, F.shiftright(up_a, 1)).otherwise(F.lit(1)).cast("long").alias("a"),
            F.when(up_a <= up_b, F.shiftright(up_b, 1)).otherwise(F.lit(0)).cast("long").alias("b"),
            F.concat(s["out"], left, right).alias("out"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["out"])


def join_ranges(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, on: list[str] | None = None) -> DataFrame:
    """All pairs of a point and a range low..high (both inside) that holds it, and that agree in `on`.

    at, low, high: whole numbers (days, seconds). Nulls and empty ranges meet
    nothing. Columns of both sides are kept; their names must differ, but for `on`.
    """
    keys = on or []
    spelt = _spelt(ranges, low, high)
    placed = _placed(points.where(F.col(at).isNotNull()), at, spelt)
    return placed.join(spelt, [*keys, "_level", "_cell"]).drop("_level", "_cell")


def fold_ranges(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, value: str) -> DataFrame:
    """ranges with what they hold: n points, the least, the most and n_distinct of their values; ranges without a point go.

    No pair is made: points are folded by place, places by cell, and a range adds
    up its cells. A value counts once a range: each of its places names the place
    before it, and those whose place before lies inside as well are taken off
    again. So after one fold of the points, work follows the places, the pairs of
    places that a value stands on in turn, and the different ranges.
    """
    places = points.where(F.col(at).isNotNull()).groupBy(F.col(value).alias("_value"), F.col(at).cast("long").alias("_at")).agg(F.count(F.lit(1)).alias("n"))
    before = F.when(F.col("_value").isNotNull(), F.lag("_at").over(Window.partitionBy("_value").orderBy("_at")))
    sums = [F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("d").alias("d")]
    marks = materialize(places.withColumn("_before", before).groupBy("_at", "_before").agg(F.sum("n").alias("n"), F.min("_value").alias("least"), F.max("_value").alias("most"), F.count("_value").alias("d")), "places")
    spelt = _spelt(ranges.select(F.col(low).cast("long").alias("_low"), F.col(high).cast("long").alias("_high")).distinct(), "_low", "_high")
    placed, cell, ends = _placed(marks, "_at", spelt), ["_level", "_cell"], ["_low", "_high"]
    held = spelt.join(placed.groupBy(*cell).agg(*sums), cell).groupBy(*ends).agg(*sums)

    again = placed.where("_before is not null").groupBy(*cell, F.col("_before").alias("_place")).agg(F.sum("d").alias("m"))
    asked = spelt.select(*cell, F.col("_low").alias("_place")).distinct()
    inside = F.sum("m").over(Window.partitionBy(*cell).orderBy(F.desc("_place")))  # of the places from this one on
    told = again.withColumn("_low", F.lit(None).cast("long")).unionByName(asked.withColumns({"m": F.lit(0).cast("long"), "_low": F.col("_place")})).withColumn("m", inside).where("_low is not null")
    twice = spelt.join(told.select(*cell, "_low", "m"), [*cell, "_low"]).groupBy(*ends).agg(F.sum("m").alias("m"))
    whole = held.join(twice, ends).select(*ends, "n", "least", "most", (F.col("d") - F.col("m")).alias("n_distinct"))
    return ranges.join(whole, (F.col(low) == F.col("_low")) & (F.col(high) == F.col("_high"))).drop(*ends)


def _spelt(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """ranges, a row for each of their cells."""
    return materialize(ranges.withColumn("_c", F.explode(cells(F.col(low), F.col(high)))).select("*", F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell")).drop("_c"), "ranges")


def _placed(points: DataFrame, at: str, spelt: DataFrame) -> DataFrame:
    """points, a row for each level that ranges use, with the cell there."""
    used = sorted(r[0] for r in spelt.select("_level").distinct().collect())  # LEVELS rows at most
    mine = F.explode(F.array(*[F.struct(F.lit(v).alias("_level"), F.shiftright(F.col(at).cast("long"), v).alias("_cell")) for v in used or [0]]))
    return points.withColumn("_p", mine).select("*", "_p._level", "_p._cell").drop("_p")
