"""Every registered query against its DuckDB oracle."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    link = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        link.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return link


@pytest.fixture(scope="module")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value:.6f}".replace("-0.000000", "0.000000")
    return str(value)


def normal(records, names, order):
    spots = [names.index(n) for n in order]
    return sorted(tuple(shown(r[i]) for i in spots) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = normal([tuple(r) for r in df.collect()], df.columns, order)
    expected = normal(result.fetchall(), names, order)
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "type", "msg_id", "num"]
    assert df.count() > 0
