"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from inkwell.llm import manifest
from tests.llm.helpers import DOCS


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, steps of each node) of a list of digests."""
    steps, at, place = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for s, p in zip(steps, place, strict=True):
            low = p // 8 * 8
            s.append(("".join(at[low:p]), "".join(at[p + 1 : low + 8])))
        at = [h("".join(at[k : k + 8])) for k in range(0, len(at), 8)]
        place = [p // 8 for p in place]
    return (at or [""])[0], steps


def plain(rows, tampered=lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0):
    """The rows of op12: rows are (doc_id, text, lang, source, n_chars)."""
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if text is not None and tampered(doc_id) else text
        langs.setdefault(lang, []).append((doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, found)))
    names = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[1] for x in sorted(langs[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for k in names}
    root, ways = tree([trees[k][0] for k in names])
    out = []
    for k, way in zip(names, ways, strict=True):
        ordered = sorted(langs[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for (doc_id, own, found), steps in zip(ordered, trees[k][1], strict=True):
            node = found
            for left, right in steps + way:
                node = h(left + node + right)
            out.append((doc_id, own, trees[k][0], root, h("".join(a + b for a, b in steps + way)), node, node == root))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, DOCS).withColumn("k", F.lit(1)).withColumn("leaf", F.lit("x")).withColumn("start", F.lit(0))
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(odd, F.translate("text", manifest.UPPER, manifest.LOWER)).otherwise(F.col("text"))
    return sorted((tuple(r) for r in manifest.manifest(df, text).collect()), key=repr)


def some(n, rng, langs=("en", "de"), ids=None):
    return [((ids or range(n))[i], rng.choice(["Ab c", "x", "ÄB É", f"t{i}", "", None]), rng.choice(langs), "s", i) for i in range(n)]


def test_sizes(spark):
    """A language for each size of a group."""
    rng = random.Random(1)
    rows = [r for n in (1, 2, 8, 9, 64, 65, 513, 700) for r in some(n, rng, (f"n{n}",))]
    rng.shuffle(rows)
    assert found(spark, rows) == plain(rows)


def test_ids_far_apart_repeated_and_null(spark):
    rng = random.Random(5)
    ids = [rng.choice([rng.randrange(-(1 << 63), 1 << 63), rng.randrange(300), -rng.randrange(70_000), None, 7]) for _ in range(400)]
    rows = some(400, rng, ("en", "de", None, "", "é", "EN", "=", "-"), ids)
    rows += [(7, "Same", "en", "s", 4)] * 600 + [(None, "Same", "en", None, None)] * 30 + [(-(1 << 63), "A", "en", "s", 1), ((1 << 63) - 1, "B", "en", "s", 1)]
    rng.shuffle(rows)
    assert found(spark, rows) == plain(rows)


def test_many_languages(spark):
    rows = [(i, f"T{i}", f"l{i % 530:03}", "s", 1) for i in range(600)]
    assert found(spark, rows) == plain(rows)


def test_one_entry_over_many_cells(spark, monkeypatch):
    """A third of all rows is one row repeated; cells are spelled out in steps."""
    monkeypatch.setattr(manifest, "SPREAD", 2)
    rows = [(5, "Hot", "en", "s", 3)] * 2500 + [(i, "x", "en", "s", 1) for i in range(20)]
    assert found(spark, rows) == plain(rows)


def test_empty_table_and_long_text(spark):
    assert found(spark, []) == []
    rows = [(1, "Word é " * 300_000, "en", "s", 1), (0, "", None, None, None)]
    assert found(spark, rows) == plain(rows)


def test_untouched_documents_verify(spark):
    df = spark.createDataFrame([(i, "A", "en", "s", 1) for i in range(20)], DOCS)
    assert all(r.verified for r in manifest.manifest(df).collect())
    one = manifest.manifest(df, F.when(F.col("doc_id") == 3, "B").otherwise(F.col("text")))
    assert [r.doc_id for r in one.where("not verified").collect()] == [3]
