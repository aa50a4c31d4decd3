"""Every registered query with an oracle equals its SQL in DuckDB; the rest return rows."""

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# too long for the suite at this size; tests/test_models.py runs them on smaller tables or with smaller ensembles
SLOW = {"grid_search", "feature_sets", "fs_lr_l1_cv"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(5).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["iv"] for r in rows] == sorted((r["iv"] for r in rows), reverse=True)
