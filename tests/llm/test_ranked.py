"""Ranked search against sums in plain Python, and the bit-sliced arithmetic against numbers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from inkwell.llm import ranked
from tests.llm.helpers import documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) of every item, by the definition."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n, words = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, c in held:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * c.total() * n // words
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        found += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return found


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def by_item(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


@pytest.mark.parametrize(("block", "together", "steps", "batch"), [(8192, 64, 16, 1 << 17), (7, 3, 2, 5)])
def test_random_texts(spark, monkeypatch, block, together, steps, batch):
    """Small blocks, groups and batches give the same as large ones."""
    for name, value in (("BLOCK_DOCS", block), ("TOGETHER", together), ("STEPS", steps), ("BATCH_TERMS", batch)):
        monkeypatch.setattr(ranked, name, value)
    rng = random.Random(block)
    words = [f"w{round(rng.paretovariate(0.7))}" for _ in range(150)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(200)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(9)]
    got = found(ranked.search(documents(spark, docs).repartition(3), items_of(spark, items)))
    assert by_item(got) == plain(docs, items)


def test_odd_texts_ids_and_ties(spark):
    docs = [(5, "Alpha beta"), (3, "alpha BETA"), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (1, None), (2, ""), (6, "ÄLPHA älpha ñ9"), (7, "a-b_c d" + " word" * 100_000), (8, " \t\n")]
    items = [(1, "alpha"), (1, "BETA"), (2, None), (3, ""), (None, "älpha ÄLPHA"), (4, "word nothing"), (5, "c b unknown"), (6, "alpha alpha beta")]
    got = found(ranked.search(documents(spark, docs, ("score", "rank", "terms")), items_of(spark, items)))
    assert by_item(got) == by_item(plain(docs, items))


def test_more_ties_than_places(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)]
    got = found(ranked.search(documents(spark, docs).repartition(4), items_of(spark, [(1, "same"), (2, "words here")])))
    assert [r[2] for r in by_item(got)] == [*range(1, 11)] * 2


def test_empty_tables(spark):
    none = items_of(spark, [])
    assert found(ranked.search(documents(spark, []), items_of(spark, [(1, "a")]))) == []
    assert found(ranked.search(documents(spark, [(1, "a")]), none)) == []
    assert found(ranked.search(documents(spark, [(1, None), (2, " ")]), items_of(spark, [(1, "a")]))) == []


def test_every_row_and_term_is_indexed(spark):
    docs = [(i, f"t{i} shared t{i}") for i in range(40)]
    index = ranked.build_index(documents(spark, docs).repartition(3))
    rows = index.collect()
    assert sum(r.n_docs for r in rows) == 40 and sum(r.n_words for r in rows) == 120
    assert sorted(bytes(t) for r in rows for t in r.terms if t != b"shared") == sorted(f"t{i}".encode() for i in range(40))


def test_carry_arithmetic_against_numbers():
    rng = np.random.default_rng(1)
    docs, queries = 150, 5
    words = -(-docs // 64)
    sums = np.zeros((queries, docs), np.int64)
    total = np.zeros((12, queries, words), np.uint64)
    for step in range(6):
        rows = queries - step % 3
        values = rng.integers(0, 300, (rows, docs)) * (rng.random((rows, docs)) < 0.6)
        sums[:rows] += values
        t, d = np.nonzero(values)
        ranked.add(total, rows, ranked.sliced(t, d, values[t, d], rows, words))
    for q in range(queries):
        bits = np.unpackbits(total[:, q].copy().view(np.uint8), axis=1, bitorder="little")[:, :docs]
        assert ((bits.astype(np.int64) << np.arange(12)[:, None]).sum(0) == sums[q]).all()
    for k in (1, 4, 10, 200):
        sure, tied = ranked.best(total, k)
        for q in range(queries):
            won, even = set(ranked._places(sure[q])), set(ranked._places(tied[q]))
            order = sorted(np.flatnonzero(sums[q]), key=lambda d: (-sums[q][d], d))
            assert [*sorted(won, key=lambda d: (-sums[q][d], d)), *sorted(even)][:k] == order[:k] and len(won) <= k


def test_long_products_stay_exact():
    sizes = np.array([0, 7, 3_000_000_000])
    n, words = 90_000_000_000, 10**13
    assert ranked.lengths(sizes, n, words).tolist() == [10 + 90 * s * n // words for s in sizes.tolist()]


def test_row_groups_of_the_index_hold_one_block(spark):
    """A reader decodes a row group's blocks at once, however many a task has written."""
    import pyarrow.parquet as pq

    # each text fills a block
    docs = spark.range(4).selectExpr("id AS doc_id", "concat('w', id, repeat(' word', 3400000)) AS text").coalesce(1)
    index = ranked.build_index(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in index.inputFiles()]
    groups = [f.metadata.row_group(g).num_rows for f in files for g in range(f.metadata.num_row_groups)]
    assert sum(groups) == 4 and max(groups) == 1
    items = spark.createDataFrame([(1, "w2 w9")], "item_id long, text string")
    assert [r.doc_id for r in ranked.search_index(index, ranked.queries_of(items)).collect()] == [2]
