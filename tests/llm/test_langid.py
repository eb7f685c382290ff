"""Language identification: held-out accuracy, codes and odd cases."""

import numpy as np
from pyspark.sql import functions as F

from inkwell.llm import langid
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == docs.count() and 0.1 < len(held) / len(got) < 0.3
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()
    assert set(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select("doc_id").toPandas().doc_id) == set(held.doc_id)


def test_prediction_reads_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit(None)).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    a, b = (dict(d.select("doc_id", "lang_pred").collect()) for d in (langid.identify(docs), langid.identify(held)))
    assert a == b


EN, DE = "the house and the garden of this town with that river ", "der garten und das haus mit einem fluss nicht weit von hier "


def learnt(n=40):
    return [(k, (EN if k % 2 else DE) * (k % 5 + 1), "en" if k % 2 else "de", "s") for k in range(n)]


def test_odd_texts(spark):
    rows = learnt() + [(100, None, None, None), (101, "", "en", None), (102, "12 34 -- \n", None, None), (103, EN * 60_000, None, None), (104, "дом", None, None), (104, "дом", None, None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(spark, rows, ("held_out", "score"))).collect()}
    assert [got[k] for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103][0] == "en" and got[104][0] in ("en", "de")


def test_no_and_one_language(spark):
    assert {r.lang_pred for r in langid.identify(documents(spark, [(1, "abc", None, "s")])).collect()} == {"und"}
    rows = [(k, "abc", "xx", "s") for k in range(9)]
    assert {(r.lang_pred, r.score) for r in langid.identify(documents(spark, rows)).collect()} == {("xx", 1.0)}
    assert langid.identify(documents(spark, [])).collect() == []


def test_kept_rows(spark):
    d = documents(spark, learnt() + [(100, None, None, None)], ("lang_pred", "ambiguous"))
    kept = langid.keep_identified(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == list(range(40))


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 20):
        w = langid.codewords(n)
        assert w.shape[0] == n and set(np.unique(w)) <= {-1.0, 1.0}
        assert all((w[i] != w[j]).sum() >= (1 if n < 3 else 2) for i in range(n) for j in range(i))


def test_decoding_corrects_a_bit_and_tells_ties():
    words = langid.codewords(4)
    model = langid.Codes(list("abcd"), words, np.zeros((langid.DIM, 7)), np.zeros(7), np.full(7, 1 / 7))
    for k, lang in enumerate("abcd"):
        for wrong in range(7):
            f = words[k] * 3.0
            f[wrong] *= -1
            assert model.decode(f)[0] == lang
    assert model.decode(np.zeros(7))[2]


def plain_counts(text):
    """Trigrams one by one."""
    low = b" " + bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text) + b" "
    found = [0] * langid.DIM
    for a, b, c in zip(low, low[1:], low[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA6B ^ c * 0xC2B2AE35) & 0xFFFFFFFF
        h ^= h >> 15
        found[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 20] += 1
    return found


def test_counts_and_values_against_plain_loops(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(langid, "PIECE", 7)  # pieces change nothing
    texts = [b"", b"a", b"ab", EN.encode(), "Grüße, дом 12!".encode(), bytes(rng.integers(0, 256, 500, np.uint8))]
    samples = [(langid.counts(t), None, lang) for k in range(30) for t, lang in ((EN[k:].encode(), "en"), (DE[k:].encode(), "de"), (f"la casa {k} y el río de la ciudad".encode(), "es"))]
    model = langid.Codes.learn(samples)
    for t in texts:
        n = plain_counts(t)
        assert langid.counts(t).tolist() == n
        f = [sum(c * float(w) for c, w in zip(n, model.weights[:, j])) / max(1, sum(n)) + float(model.bias[j]) for j in range(model.weights.shape[1])]
        assert np.allclose(model.bits(t), f, atol=1e-5)
        losses = [sum(float(model.trust[j]) * np.log1p(np.exp(-max(-30, min(30, model.words[i, j] * f[j])))) for j in range(len(f))) for i in range(len(model.langs))]
        assert model.decode(np.array(f))[0] == model.langs[int(np.argmin(losses))]


def test_repeated_rows_leave_every_language(spark):
    """A third and more of all rows is one text without id: the others are learned all the same, and reruns agree."""
    rows = [(None, EN, "en", "s")] * 6000 + [(1000 + k, f"{DE} {k}", "de", "s") for k in range(400)] + [(None, DE, "de", "s")] * 50
    d = documents(spark, rows)
    a = langid.training_sample(d, per_lang=60)
    assert sum(lang == "de" for *_, lang in a) == 60 and sum(lang == "en" for *_, lang in a) == 1
    b = langid.training_sample(d.repartition(7), per_lang=60)
    assert [(n.tolist(), lang) for n, _, lang in a] == [(n.tolist(), lang) for n, _, lang in b]


def test_rare_languages_are_learned_and_whole_texts_are(spark):
    rare = [(1000 + k, f"xqzw kvjx {k} wqxz jkvq " * 3, f"r{k % 3}", "s") for k in range(30)]
    d = documents(spark, [*learnt(400), *rare, (None, EN, "en", "s"), (7, DE * 4000, "de", "s")])
    sample = langid.training_sample(d)
    assert {lang for *_, lang in sample} == {"en", "de", "r0", "r1", "r2"}
    assert max(int(whole.sum()) for whole, *_ in sample) > len(DE) * 3999
    bounded = langid.training_sample(d, per_lang=5)
    assert len(bounded) <= 25 and {lang for *_, lang in bounded} == {"en", "de", "r0", "r1", "r2"}
