"""Every registered query of the news engine against its SQL in DuckDB."""

import os

import duckdb
import pytest

from inkwell import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in os.listdir(SF):
        files = f"{SF}/{p}/*.parquet" if os.path.isdir(f"{SF}/{p}") else f"{SF}/{p}"
        con.execute(f"CREATE VIEW {p.removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.where(df.notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in catalogue.ORACLES:
        want = duck.execute(catalogue.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
