"""Mixing against a plain version."""

import hashlib
import math
import random
import re
from collections import defaultdict

from inkwell.llm import mixing
from tests.llm.helpers import documents


def plain_targets(sizes):
    """Waterfilling by rounds: what is over the cap goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, total = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return share | full
        full |= {s: 2.0 * sizes[s] for s in over}


def plain(rows, weights):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    text_hash = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    by = defaultdict(list)
    for i, t, _, s in rows:
        u = (int(hashlib.md5(f"{'' if i is None else i}{text_hash(t)}mix".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
        by[s].append((-math.log(u) / weights.get(i, 1.0), i, size(t), int(text_hash(t)[:15], 16)))
    sizes = {s: sum(x[2] for x in held) for s, held in by.items()}
    goals, out = plain_targets(sizes), []
    for s, held in by.items():
        epochs = math.floor(goals[s] / sizes[s] + 1e-9) if sizes[s] else 0
        at = 0
        for _, i, n, _ in sorted(held, key=lambda x: (x[0], -(10**9) if x[1] is None else x[1], *x[2:])):
            extra = n > 0 and 2 * at + n <= 2 * (goals[s] - epochs * sizes[s]) + 1e-6
            out.append((i, n, sizes[s], round(goals[s], 6), (epochs + extra) * n))
            at += n
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def table(n, sources):
    rng = random.Random(3)
    return [(i, " ".join("w" for _ in range(rng.randrange(40))), "en", rng.choice(sources)) for i in range(n)]


def test_against_plain(spark):
    rows = table(700, ["b"] * 8 + ["a", "é", "Z", None]) + [(10_000, None, "en", "b"), (10_001, "", "en", "empty")]
    weights = {i: 0.5 + (i % 2) * 1.5 for i in range(0, 700, 3)}
    w = spark.createDataFrame(list(weights.items()), "doc_id long, weight double")
    assert found(mixing.mix(documents(spark, rows, ("key", "bucket", "weight", "prefix")), w)) == plain(rows, weights)


def test_hot_source_spans_buckets_and_taken_is_near_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    monkeypatch.setattr(mixing, "SUPER", 4)
    rows = table(900, ["a"] * 5 + ["b", "c"])
    got = mixing.mix(documents(spark, rows)).collect()
    assert found(mixing.mix(documents(spark, rows).repartition(7))) == plain(rows, {})
    taken, target = defaultdict(int), {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_no_words_and_no_rows(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert found(mixing.mix(documents(spark, [(1, None), (1, None), (2, " ")]))) == [(1, 0, 0, 0.0, 0)] * 2 + [(2, 0, 0, 0.0, 0)]


def test_rows_of_the_mix(spark):
    rows = table(300, ["a", "a", "a", "b", None]) + [(7, "other text under an id of before", "en", "a")]
    d = documents(spark, rows, ("_copy", "_id"))
    copies = sum(r.copies for r in mixing.mix(d).collect())
    mixed = mixing.mixed_rows(d)
    assert mixed.columns == d.columns and mixed.count() == copies


def test_weights_draw_documents_of_quality_first(spark):
    rows = [(i, "one two three", "en", "s" if i < 800 else "t") for i in range(3000)]
    good = spark.createDataFrame([(i, 50.0) for i in range(800, 1000)], "doc_id long, weight double")
    got = {r.doc_id: r.copies for r in mixing.mix(documents(spark, rows), good).collect()}
    share = sum(got[i] for i in range(800, 1000)) / 200
    rest = sum(got[i] for i in range(1000, 3000)) / 2000
    assert share > rest


def test_reruns_agree_where_ids_repeat_or_lack(spark):
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, None, k]), f"{k % 60} " * rng.randrange(1, 9), "en", "s" if k % 3 else "t") for k in range(400)]
    want = plain(rows, {})
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        assert found(mixing.mix(documents(spark, rows).repartition(parts))) == want
    mixed = mixing.mixed_rows(documents(spark, rows, ("row", "_taken")))
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(w[-1] for w in want)


def test_buckets_are_even_whatever_the_weights(spark):
    rows = [(k, f"word {k}", "en", "s") for k in range(20_000)]
    weights = {k: (0.25, 1.0, 4.0)[k % 3] for k in range(20_000)}
    d = documents(spark, rows)
    w = spark.createDataFrame(list(weights.items()), "doc_id long, weight double")
    assert found(mixing.mix(d, w)) == plain(rows, weights)
    u = [(int(hashlib.md5(f"{k}{hashlib.md5(t.encode()).hexdigest()}mix".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48) for k, t, *_ in rows]
    above = [sum(math.exp(-w * -math.log(x) / weights[k]) for w in (0.25, 1.0, 4.0)) / 3 for k, x in enumerate(u)]
    n = -(-20_000 // mixing.BUCKET)
    in_bucket = defaultdict(int)
    for a in above:
        in_bucket[min(n - 1, int((1 - a) * n))] += 1
    assert max(in_bucket.values()) < 2 * mixing.BUCKET
