"""Every registered query against its DuckDB oracle on the smallest test
tables (the driver runs the same comparison at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, frame, frame_hash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - {"pipeline"}))
def test_query_matches_oracle(spark, duck, name):
    got = frame_hash(frame(E.queries()[name](spark, SF)))
    exp = frame_hash(duck.execute(E.oracle_sql()[name]).fetchdf())
    assert got[:3] == exp[:3]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["source_platform", "article_count",
                                              "earliest_pub", "latest_pub"]


def test_every_query_has_an_oracle():
    from quire.plans.registry import all_oracles, all_queries
    assert set(all_queries()) == set(all_oracles())
    assert set(E.oracle_sql()) <= set(E.queries())
