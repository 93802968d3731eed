import datetime as dt

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from salescp.plans.oracle import ORACLE
from salescp.plans.queries import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["categoria", "year", "histogram"]
    assert len(rows) > 0
    assert all(r.histogram.startswith("{") and r.histogram.endswith("}") for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_small(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert isinstance(rows, list)
    if "change_point" in df.columns:
        assert all(r.change_point is None or isinstance(r.change_point, dt.date) for r in rows)
