"""Every registered query against its DuckDB oracle on the smallest scale factor
(the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_compare import compare
from yardstick.plans import registry
from yardstick.sources.derived import TABLES

KEYS = sorted(registry.all_queries())


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_small, key):
    r = compare(spark, con, sf_small, key, entry.queries()[key], entry.oracle_sql().get(key))
    if r.get("oracle", 1) is None:
        pytest.skip("no SQL oracle for this key")
    assert r["cols"], r
    assert r["count"], r
    assert r["hash"], r
    assert r["types"], r


def test_every_query_has_an_oracle():
    assert set(registry.all_oracles()) == set(registry.all_queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
