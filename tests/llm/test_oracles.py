"""The queries that SQL can express, against DuckDB on the whole tables."""

import pytest
from conftest import SF_ORACLE
from oracle_compare import canon, duck

from salescp.llm.oracle import ORACLE
from salescp.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SF_ORACLE)
    sql = duck(SF_ORACLE).execute(ORACLE[name])
    assert canon(frame.columns, [tuple(r) for r in frame.collect()]) == canon([d[0] for d in sql.description], sql.fetchall())
