"""The driver contract: entry() runs; every query has an oracle and runs on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from roundbook.sources.testviews import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["row_id", "company"]


def test_every_query_has_an_oracle():
    from roundbook import queries as own

    assert set(own.QUERIES) == set(own.ORACLE) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["match_urls", "funding_text", "rounds_listing", "quarterly_pivot", "top_investors"])
def test_query_matches_oracle_small(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    from scripts.oracle_check import norm_frame

    assert norm_frame(sp) == norm_frame(dk)
