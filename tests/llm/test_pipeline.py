"""The pipeline's stages against plain versions, and the registered queries."""

import base64
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from inkwell.llm import langid, mixing, queries
from inkwell.llm.langid import Codes, training_sample
from tests.llm.helpers import documents
from tests.llm.test_ngrams import near_copies, plain

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "encode"]
    rows = {r.doc_id: r for r in docs.collect()}

    told = stages["language_id"](spark, docs, SF)
    model = Codes.learn(training_sample(docs.select("doc_id", "lang", "text")))
    kept = sorted(i for i, r in rows.items() if not model.predict((r.text or "").encode())[2])
    assert told.columns == docs.columns and sorted(r.doc_id for r in told.collect()) == kept and len(kept) > 0.95 * len(rows)

    first = {}
    for i in kept:
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", rows[i].text or ""), i)
    unique = stages["exact_dedup"](spark, told, SF)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(first.values())

    near = stages["near_dedup"](spark, unique, SF)
    singles = sorted(i for i, _, c in plain([(i, rows[i].text) for i in first.values()], 5, 80, 100) if i == c)
    assert sorted(r.doc_id for r in near.collect()) == singles

    mixed = stages["mix_sources"](spark, near, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix(near, mixing.quality_weights(spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in stages["encode"](spark, mixed, SF).collect():
        assert r.ids == library.encode_ordinary(rows[r.doc_id].text or "") and r.n_tokens == len(r.ids)


def test_stages_on_odd_rows(spark):
    rows = [(k, "the house and the garden " * (k % 4 + 1) + f"{k}", "en", "s") for k in range(12)] + [(100, None, None, None), (101, "", "en", "s"), (102, "12", "en", None), (3, "the house", "en", "t"), (3, "the house", "en", "t")]
    d = documents(spark, rows, ("_gone", "key", "copies"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, d, SF)
        assert got.columns == d.columns, name
        got.collect()
        assert stage(spark, documents(spark, []), SF).collect() == []
    assert len(corpus_pipeline.STAGES[-1][1](spark, d, SF).collect()) == len(rows)


def test_near_copies_leave_one(spark):
    rows = near_copies(5)
    left = corpus_pipeline.near_dedup(spark, documents(spark, rows), SF)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _, c in plain(rows, 5, 80, 100) if i == c)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert got.count() > 0 and langid.UND not in got.columns


def rows_of(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(str(round(v, 6) if isinstance(v, float) else v) for v in r) for r in df.where(df.notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows_of(queries.QUERIES[name](spark, SF).toPandas()) == rows_of(con.execute(queries.ORACLES[name]).df())


def test_one_query_for_every_operator():
    found = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in queries.QUERIES) if m)
    assert found == list(range(1, 14)) and "pipeline" in queries.QUERIES
