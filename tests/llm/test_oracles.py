"""The registered queries that SQL can express, against DuckDB."""

import pytest

from roadrisk.llm.queries import ORACLE, QUERIES
from roadrisk.plans.compare import duckdb_con

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF)
    want = duckdb_con(SF).sql(ORACLE[name]).select(*got.columns)
    rows = lambda found: sorted(tuple(map(str, r)) for r in found)
    assert rows(got.collect()) == rows(want.fetchall()) != []
