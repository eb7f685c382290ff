"""The quality classifier: held-out figures, trees and odd cases."""

import numpy as np
from pyspark.sql import functions as F

from inkwell.llm import quality
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.op9_quality_score(spark, SF).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0.3).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_every_row_is_scored(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 200_000), (4, "again"), (5, "x" * 100)]
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (4, 0, 0), (9, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(documents(spark, rows, ("stats", "score")), labels).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 4, 5] and all(0 <= r.score <= 1 for r in got)
    assert quality.score(documents(spark, []), labels).collect() == []


def test_labels_of_one_kind_and_none(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.score(documents(spark, [(1, "a")]), none).collect()] == [0.5]
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.score(documents(spark, [(i, "a") for i in range(20)]), one).collect()} == {1}


def test_the_sample_is_bounded_and_reruns_agree(spark):
    """An id that stands for a third of all rows, and more labels than the sample holds."""
    rows = [(1, "hot text " * (k % 7 + 1)) for k in range(900)] + [(i, "good words here" if i % 2 else "### $$$") for i in range(2, 700)]
    labels = spark.createDataFrame([(1, 1)] * 50 + [(i, i % 2) for i in range(2, 700)], "doc_id long, quality int")
    stats = quality.with_statistics(documents(spark, rows).repartition(5))
    again = quality.with_statistics(documents(spark, rows[::-1]).repartition(3))
    a, b = (quality.learn(s, labels, 40) for s in (stats, again))
    assert (a.start, a.value.tolist()) == (b.start, b.value.tolist())


def test_statistics_against_plain_counts():
    """Each statistic by its words, from a text's characters."""
    import math

    texts = [b"Good words, twice: good words!\n\nA line | with {a} b@c/d 12%\nA line | with {a} b@c/d 12%\n", "é ÉÉ ß".encode(), b"x", b" \n ", b"aa aa aa bb"]
    for t in texts:
        s = dict(zip(quality.STATS, quality.statistics(t), strict=True))
        words, lines, n = t.split(), [x for x in t.split(b"\n") if x.strip()], len(t)
        pairs = list(zip(words, words[1:]))
        want = {
            "bytes": math.log1p(n), "words": math.log1p(len(words)), "word_length": sum(map(len, words)) / max(1, len(words)), "longest_word": math.log1p(max(map(len, words), default=0)),
            "upper": sum(65 <= c <= 90 for c in t) / n, "digits": sum(48 <= c <= 57 for c in t) / n, "exclamations": t.count(b"!") / n, "points": t.count(b".") / n, "commas": t.count(b",") / n, "pipes": t.count(b"|") / n,
            "beyond_ascii": sum(c >= 128 for c in t) / n, "distinct_words": len(set(words)) / max(1, len(words)), "top_word": max((words.count(w) for w in words), default=0) / max(1, len(words)),
            "short_words": sum(len(w) <= 3 for w in words) / max(1, len(words)), "lines": math.log1p(len(lines)), "line_length": n / max(1, len(lines)), "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
            "longest_line": math.log1p(max(map(len, lines), default=0)), "capitalised": sum(w[:1].isupper() for w in words) / max(1, len(words)), "repeated_pairs": 1 - len(set(pairs)) / max(1, len(words) - 1),
            "braces": sum(c in b"{}[]" for c in t) / n, "at_and_slash": sum(c in b"@/" for c in t) / n, "symbols": sum(c in b"#*$%&<>" for c in t) / n,
        }
        if words:
            assert {k: round(s[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}, t


def test_grown_trees_take_the_best_split():
    """The first split of a tree is the one that a search over all cuts finds."""
    rng = np.random.default_rng(5)
    x, y = rng.random((400, 3)).round(2), (rng.random(400) < 0.3).astype(float)
    y[x[:, 1] > 0.6] = 1
    model = quality.Trees.grow(x, y, trees=1)
    p = y.mean()
    g, h = p - y, np.full(400, p * (1 - p))

    def gain(j, c):
        left = x[:, j] <= c
        if min(left.sum(), (~left).sum()) < quality.LEAST:
            return 0
        return g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)

    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS + 1)[1:-1])) for j in range(3)]
    best = max(((gain(j, c), j, c) for j in range(3) for c in cuts[j]))
    assert (model.feature[0, 0], model.cut[0, 0]) == (best[1], best[2])


def test_held_out_labels_are_not_read(spark):
    docs = documents(spark, [(i, "good words here" if i % 2 else "### $$$") for i in range(120)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (dict(quality.score(docs, x).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a == b


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.Trees.grow(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    slow = [one_by_one(model, r) for r in x[:50]]
    assert np.allclose(slow, model.scores(x[:50]))


def one_by_one(model, row):
    f = model.start
    for feature, cut, value in zip(model.feature, model.cut, model.value, strict=True):
        at = 0
        while at < len(feature):
            at = 2 * at + (2 if row[feature[at]] > cut[at] else 1)
        f += value[at - len(feature)]
    return 1 / (1 + np.exp(-f))
