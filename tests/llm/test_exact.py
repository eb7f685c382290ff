"""Exact dedup against grouping in Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from inkwell.llm import exact
from inkwell.llm.common import named_rows
from tests.llm.helpers import documents


def plain(rows):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)


def found(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


ROWS = [(5, "a b"), (3, "a\t\n b"), (9, "a b"), (1, None), (2, ""), (4, " "), (6, "\n"), (7, "é" * 50_000), (8, "é" * 50_000), (8, "é" * 50_000), (10, "A b"), (11, "a\xa0b"), (0, "x")]


def test_small_cases(spark):
    assert found(exact.dedup_exact(documents(spark, ROWS, ("digest", "norm", "keep_id", "_gone")))) == plain(ROWS)


def test_a_third_of_all_rows(spark):
    rng = random.Random(1)
    rows = [(i, "hot text" if i % 3 == 0 else f"text {rng.randrange(300)}") for i in range(900)]
    rng.shuffle(rows)
    assert found(exact.dedup_exact(documents(spark, rows).repartition(5))) == plain(rows)


def test_empty_table(spark):
    assert exact.dedup_exact(documents(spark, [])).collect() == []


def test_rows_with_equal_digests_and_other_bytes(spark, monkeypatch):
    """A digest of the length alone: verification must part what it joins."""
    monkeypatch.setattr(exact, "digest_of", lambda norm: F.unhex(F.lpad(F.length(norm).cast("string"), 8, "0")))
    rows = [(1, "aa"), (2, "ab"), (3, "aa"), (4, "abc"), (5, "abc"), (6, "z"), (7, "ab")]
    got = [r[:4] for r in found(exact.dedup_exact(documents(spark, rows)))]
    assert got == [r[:4] for r in plain(rows)]


def test_hits_are_compared_by_their_bytes(spark, monkeypatch):
    """Texts that agree in digest, length and every other hash still are told apart."""

    class Blind:
        def __getattr__(self, name):
            return (lambda *columns: F.lit(0).cast("long")) if name == "xxhash64" else getattr(F, name)

    monkeypatch.setattr(exact, "F", Blind())
    monkeypatch.setattr(exact, "digest_of", lambda norm: F.unhex(F.lpad(F.length(norm).cast("string"), 8, "0")))
    rows = [(1, "aa"), (2, "ab"), (3, "aa"), (4, "abc"), (5, "abc"), (6, "z"), (7, "ab")]
    got = [r[:4] for r in found(exact.dedup_exact(documents(spark, rows)))]
    assert got == [r[:4] for r in plain(rows)]


def test_rows_that_stay_keep_their_columns(spark):
    d = documents(spark, ROWS, ("_gone", "digest"))
    kept = exact.keep_first(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, k, _ in plain(ROWS) if k)


def test_rows_that_stay_under_repeated_and_null_ids(spark):
    rows = [(3, "x"), (5, "x"), (5, "own text"), (3, "x"), (3, "other"), (None, "x"), (None, "alone"), (None, "alone"), (None, None), (9, ""), (5, "own  text")]
    kept = exact.keep_first(documents(spark, rows, ("_row", "place")).repartition(3))
    assert sorted((str(r.doc_id), r.text.split()) for r in kept.collect()) == [("3", ["other"]), ("3", ["x"]), ("5", ["own", "text"]), ("9", []), ("None", ["alone"])]


def test_exactly_one_row_of_each_text_is_kept(spark):
    rows = [(5, "x"), (5, "x"), (3, "x"), (3, "x"), (3, "y"), (None, "x"), (None, "z"), (None, "z"), (None, None), (4, "y")]
    got = exact.dedup_exact(documents(spark, rows, ("row", "first", "rows", "run")).repartition(4)).collect()
    assert all(r.kept is not None for r in got) and len(got) == len(rows)
    kept = sorted((str(r.doc_id), r.keep_id, r.group_size) for r in got if r.kept)
    assert kept == sorted([("3", 3, 5), ("3", 3, 2), ("None", None, 2), ("None", None, 1)])
    assert {r.keep_id for r in got if r.group_size == 5} == {3}


def test_copies_fold_before_they_leave_a_task(spark):
    d = documents(spark, [(i, f"text {i % 7}") for i in range(500)]).coalesce(2)
    log = exact.write_log(d.withColumn("row", F.monotonically_increasing_id()))
    runs = exact.flush_runs(log)
    assert log.count() == 500 and runs.count() <= 7 * runs.select("run").distinct().count()
    index = exact.compact(runs)
    assert {r.rows for r in index.collect()} == {71, 72}
    want = [bytes(r.digest) for r in index.limit(2).collect()]
    assert sorted(bytes(r.digest) for r in exact.lookup(index, want).collect()) == sorted(want)
    assert exact.lookup(index, [bytes(32)]).count() == 0


def test_no_text_moves(spark):
    """Whatever number of copies there is, the plans shuffle digests, not texts."""
    plan = exact.dedup_exact(documents(spark, [(i, f"long text {i % 5} " * 50) for i in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "norm" not in plan and "text#" not in plan


def test_ids_name_rows_only_where_they_can(spark):
    unique = documents(spark, [(2, "x"), (1, "x"), (3, None)])
    assert named_rows(unique)[1] == "doc_id" and named_rows(unique)[0] is unique
    assert named_rows(documents(spark, []))[1] == "doc_id"
    for rows in ([(1, "x"), (1, "y")], [(1, "x"), (None, "y")]):
        numbered, row = named_rows(documents(spark, rows, ("_row",)))
        assert row == "__row" and len({r[row] for r in numbered.collect()}) == 2
    assert named_rows(unique.withColumn("doc_id", F.col("doc_id").cast("string")))[1] == "_row"
