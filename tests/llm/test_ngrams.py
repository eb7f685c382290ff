"""The Jaccard join against all pairs in Python."""

import random
import re

import numpy as np
import pytest

from inkwell.llm import graph, ngrams
from tests.llm.helpers import documents


def gram_set(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def plain(rows, n, num, den):
    """Every pair compared, then union-find; rows that repeat an id are one node."""
    sets = [(i, gram_set(t, n)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted((i, len(s), root(i) if s else i) for i, s in sets)


def near_copies(seed, families=12, size=9, words=(1, 200)):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(4000)] + ["the", "Of"] * 20
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(*words))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [text[at], rng.choice(vocabulary)]])
            rows.append((len(rows), (" " if rng.random() < 0.9 else "\n").join(text)))
    rng.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_ngrams", "component_id").collect())


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (1, 60, 100)])
def test_against_all_pairs(spark, n, num, den):
    rows = near_copies(n)
    got = found(ngrams.jaccard_components(documents(spark, rows, ("node", "digest", "part")).repartition(3), n, num, den))
    assert got == plain(rows, n, num, den)
    assert len({c for _, _, c in got}) < len(rows)


def test_short_and_odd_texts(spark):
    rows = [(9, None), (8, ""), (7, " \n"), (6, "a"), (5, "A"), (4, "a b"), (3, "b a"), (2, "a b c"), (1, "x y z w"), (0, "x y z w v"), (10, "é é é"), (11, "É é é"), (12, "word " * 100_000), (13, "word " * 90_000), (14, "a\xa0b c d"), (15, "same words here now"), (15, "same words here now")]
    assert found(ngrams.jaccard_components(documents(spark, rows), 3, 90, 100)) == plain(rows, 3, 90, 100)
    assert found(ngrams.jaccard_components(documents(spark, []))) == []


def test_repeated_and_null_ids(spark):
    rows = [(1, "one two three four"), (1, "five six seven eight"), (2, "five six seven eight"), (3, "one two three four"), (None, "one two three four"), (None, None)]
    got = [tuple(r) for r in ngrams.jaccard_components(documents(spark, rows), 3, 90, 100).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (None, 2, 1), (None, 0, None)], key=str)


def test_links_through_rows_without_id(spark):
    words = [f"w{k}" for k in range(100)]
    a, c = " ".join(words), " ".join([*words[6:], *(f"z{k}" for k in range(6))])
    b = " ".join([*words[3:], *(f"z{k}" for k in range(3))])
    alone = "a text that nobody else has at all"
    rows = [(1, a), (None, b), (3, c), (None, alone), (None, alone), (None, "x"), (None, None), (2, None), (7, "x"), (7, "y"), (None, "y"), (8, "y")]
    got = [tuple(r) for r in ngrams.jaccard_components(documents(spark, rows, ("name", "id")).repartition(3), 3, 90, 100).collect()]
    n = {t: len(ngrams.ngram_set(t.encode() if t else None, 3)) for _, t in rows}
    want = [(1, n[a], 1), (None, n[b], 1), (3, n[c], 1), (None, n[alone], None), (None, n[alone], None), (None, 1, 7), (None, 0, None), (2, 0, 2), (7, 1, 7), (7, 1, 7), (None, 1, 7), (8, 1, 7)]
    assert sorted(got, key=str) == sorted(want, key=str)
    # without the row in the middle there is no link
    assert {r.component_id for r in ngrams.jaccard_components(documents(spark, [(1, a), (3, c)]), 3, 90, 100).collect()} == {1, 3}


def test_names_of_rows_without_id_are_no_ids(spark):
    """An id that is the hash of a text without id is not taken for it."""
    from pyspark.sql import functions as F

    taken = spark.range(1).select(F.xxhash64(F.lit("one two three four"), F.lit(0))).first()[0]
    rows = [(taken, "quite other words in this"), (None, "one two three four"), (5, "one two three four")]
    got = sorted((tuple(r) for r in ngrams.jaccard_components(documents(spark, rows), 3, 90, 100).collect()), key=str)
    assert got == sorted([(taken, 3, taken), (None, 2, 5), (5, 2, 5)], key=str)


def test_an_id_that_repeats_joins_its_texts(spark):
    a, b, c = "one two three four", "five six seven eight", "nine ten eleven twelve"
    for rows in ([(2, a), (3, b), (5, a), (5, b)], [(4, a), (9, a), (9, b), (7, b), (9, c), (8, c), (1, "x y z"), (1, c + " x")], [(6, a), (6, b), (6, c), (9, a + " more " * 3), (2, b)]):
        assert found(ngrams.jaccard_components(documents(spark, rows).repartition(3), 3, 90, 100)) == plain(rows, 3, 90, 100)
    rng = random.Random(4)
    rows = [(rng.randrange(40), t) for _, t in near_copies(11, families=10, size=6, words=(20, 60))]
    assert found(ngrams.jaccard_components(documents(spark, rows).repartition(3), 3, 90, 100)) == plain(rows, 3, 90, 100)


def test_large_families_are_cut_into_leaves(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "LEAF_POINTS", 4)
    rows = near_copies(7, families=2, size=30, words=(150, 160)) + [(500 + k, f"copy of one text {k % 2} " * 3) for k in range(40)]
    assert found(ngrams.jaccard_components(documents(spark, rows).repartition(4), 3, 90, 100)) == plain(rows, 3, 90, 100)


def test_a_chain_of_unlike_texts_moves_in_proportion(spark, monkeypatch):
    """Texts that share parts with their neighbours alone are one family; each meets its neighbours, not all leaves."""
    monkeypatch.setattr(ngrams, "LEAF_POINTS", 4)
    links, moved = ngrams._links, []
    monkeypatch.setattr(ngrams, "_links", lambda sets, *a: moved.append(sets.selectExpr("sum(leaves)").first()[0]) or links(sets, *a))
    words = [f"w{k}" for k in range(1700)]
    rows = [(k, " ".join(words[k * 20 : k * 20 + 60])) for k in range(80)]
    rows += [(400 + k, " ".join([*words[k * 20 : k * 20 + 59], "other"])) for k in range(0, 80, 7)] + [(800, rows[50][1])]
    assert found(ngrams.jaccard_components(documents(spark, rows).repartition(4), 3, 70, 100)) == plain(rows, 3, 70, 100)
    assert moved[0] < 12 * len(rows)  # a text went to each of 23 leaves and more before


@pytest.mark.parametrize("num", [60, 80, 90])
def test_linked_sets_share_a_part(num):
    rng, ranges = np.random.default_rng(1), ngrams.Ranges(num, 100)
    for _ in range(400):
        size = int(rng.integers(1, 300))
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        b = np.concatenate([a[int(rng.integers(0, 1 + size // 6)) :], rng.integers(0, 2**64, int(rng.integers(0, 1 + size // 6)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= num * (len(a) + len(b) - both):
            assert np.intersect1d(ngrams.parts_of(a, ranges), ngrams.parts_of(b, ranges)).size


def test_bound_never_drops_a_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 120, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(120) < 0.08, rng.integers(0, 2**64, 120, dtype=np.uint64), base)) for _ in range(150)]
    tree = ngrams.CountTree(sets, 80, 100)
    passed = {tuple(sorted((int(tree.order[a]), int(tree.order[b])))) for i, j in tree.pairs() for a, b in zip(i, j, strict=True)}
    linked = {(i, j) for i in range(150) for j in range(i + 1, 150) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert linked and linked <= passed
    strangers = [np.unique(rng.integers(0, 2**64, 120, dtype=np.uint64)) for _ in range(150)]
    assert sum(len(i) for i, _ in ngrams.CountTree(strangers, 80, 100).pairs()) < 0.05 * 150 * 149 / 2


def test_one_of_each_group_stays(spark):
    rows = near_copies(3)
    d = documents(spark, rows, ("_gone", "component_id"))
    kept = ngrams.keep_one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in plain(rows, 5, 80, 100) if i == c)


def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 1), (7, None)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)} | {k: 200 for k in (200, 201, 202)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays_under_repeated_and_null_ids(spark):
    x, own = "one two three four five six", "quite another text with words of its own"
    rows = [(5, x), (5, own), (3, x), (3, x), (None, x), (None, "alone " * 9), (None, "alone " * 9), (4, None), (4, ""), (None, None)]
    kept = ngrams.keep_one_of_each(documents(spark, rows, ("_row", "place")).repartition(3))
    want = [(3, x), (5, own), (None, "alone " * 9), (4, None), (4, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
