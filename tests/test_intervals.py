"""Range joins against plain pairs."""

import random

from pyspark.sql import functions as F

from inkwell.operators import intervals


def pairs(df):
    return sorted((r.p, r.r) for r in df.select("p", "r").collect())


def test_cells_are_disjoint_and_cover(spark):
    rng = random.Random(1)
    rows = [(0, 0), (0, 7), (1, 7), (5, 4), (-3, 9), (-8, -1), (3, 3), (1, 1 << 33)] + [(a, a + rng.randrange(400)) for a in (rng.randrange(-500, 500) for _ in range(60))]
    for (low, high), cells in zip(rows, spark.createDataFrame(rows, "a long, b long").select(intervals.cells(F.col("a"), F.col("b"))).collect(), strict=True):
        got = sorted((c.cell << c.level, (c.cell + 1 << c.level) - 1) for c in cells[0])
        assert len(got) <= 2 * 40
        assert [x for x, _ in got] == [low, *(y + 1 for _, y in got[:-1])] and got[-1][1] == high if low <= high else got == []


def test_random_windows_of_any_width(spark):
    rng = random.Random(2)
    ranges = [(i, k, a, a + w) for i, (k, a, w) in enumerate((rng.randrange(3), rng.randrange(-900, 900), rng.choice([0, 1, 3, 30, 399, 4000, -5])) for _ in range(150))]
    points = [(i, rng.randrange(3), rng.choice([5, rng.randrange(-1500, 1500)])) for i in range(300)] + [(900, None, 5), (901, 1, None)]
    p = spark.createDataFrame(points, "p long, k long, at long").repartition(3)
    r = spark.createDataFrame([*ranges, (800, 1, None, 5), (801, None, 0, 9)], "r long, k long, low long, high long")
    joined = intervals.join_ranges(p, r, "at", "low", "high", ["k"])
    assert pairs(joined) == sorted((i, j) for i, k, at in points if at is not None for j, kk, low, high in ranges if k == kk and low <= at <= high)
    whole = intervals.join_ranges(p.drop("k"), r, "at", "low", "high")
    assert pairs(whole) == sorted((i, j) for i, _, at in points if at is not None for j, _, low, high in [*ranges, (801, None, 0, 9)] if low <= at <= high)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.join_ranges(p, r.where("false"), "at", "low", "high", ["k"]).collect() == []


def test_what_ranges_hold(spark):
    """Folds against all pairs: values on several places, twice on one, none; the same range twice; ranges without points."""
    rng = random.Random(3)
    ranges = [(i, a, a + w) for i, (a, w) in enumerate((rng.randrange(-60, 60), rng.choice([0, 1, 3, 30, 99, 4000, -5])) for _ in range(120))] + [(900, 3, 20), (901, 3, 20), (902, None, 5), (903, 5, None), (904, 9000, 9001)]
    points = [(rng.choice([None, *range(40)]), rng.choice([5, rng.randrange(-90, 90)])) for _ in range(400)] + [(7, None), (500, 3), (500, 3)]
    want = {}
    for i, low, high in ranges:
        held = [v for v, at in points if None not in (low, high, at) and low <= at <= high]
        named = [v for v in held if v is not None]
        if held:
            want[i] = (len(held), min(named, default=None), max(named, default=None), len(set(named)))
    p, r = spark.createDataFrame(points, "v long, at long").repartition(3), spark.createDataFrame(ranges, "r long, low long, high long")
    got = intervals.fold_ranges(p, r, "at", "low", "high", "v")
    assert got.columns == ["r", "low", "high", "n", "least", "most", "n_distinct"]
    assert {x.r: (x.n, x.least, x.most, x.n_distinct) for x in got.collect()} == want and got.count() == len(want)
    assert intervals.fold_ranges(p, r.where("false"), "at", "low", "high", "v").collect() == [] == intervals.fold_ranges(p.where("false"), r, "at", "low", "high", "v").collect()


def test_windows_of_suppliers_make_no_pairs(spark, monkeypatch):
    from inkwell.plans import calendar

    monkeypatch.delattr(intervals, "join_ranges")
    assert calendar.wide_range_join(spark, "/root/testdata/sf0.001").count()
