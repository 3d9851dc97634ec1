"""Every SQL-expressible registered query equals its DuckDB twin (sf0.001)."""

import pytest

from roadrisk.plans.compare import compare
from roadrisk.plans.oracle_queries import ORACLE
from roadrisk.plans.registry import QUERIES

from conftest import SF_SMALL


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == set()
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck_small, name):
    r = compare(spark, duck_small, name, SF_SMALL)
    assert r["ok"], r


def test_verify_outputs_rows(spark):
    rows = QUERIES["verify_outputs"](spark, SF_SMALL).collect()
    assert len(rows) == 6
    assert all(r.exists and r.non_empty for r in rows)
