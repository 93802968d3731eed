"""Generated-input property tests (hypothesis), no Spark session needed for the DP ones."""

import datetime as dt

import numpy as np
import pytest
import rules
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salescp.operators import edpelt as E

D0 = dt.date(2024, 1, 1)

points = st.lists(
    st.tuples(st.integers(0, 8), st.sampled_from([0.0, 1.0, 1.5, 2.0, 5.0, 9.5])),
    min_size=3, max_size=11,
)


def _dp(dates, values):
    order = sorted(range(len(dates)), key=lambda i: dates[i])
    dates = [dates[i] for i in order]
    values = [float(values[i]) for i in order]
    k, _, Pl = rules.edpelt_tables(values)
    uniq = sorted(set(dates))
    ends = [max(i for i in range(len(dates)) if dates[i] == d) + 1 for d in uniq]
    tau = np.array([0] + ends)
    P = np.array([[Pl[i][t] for i in range(k)] for t in tau])
    return [uniq[b - 1] for b in E.solve(P, tau, k)]


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(points)
def test_dp_is_optimal(pts):
    dates = [D0 + dt.timedelta(days=d) for d, _ in pts]
    values = [v for _, v in pts]
    got = _dp(dates, values)
    assert got == rules.edpelt_points(dates, values)
    assert rules.edpelt_total(dates, values, got) == pytest.approx(
        rules.edpelt_brute_cost(dates, values), rel=1e-12, abs=1e-12)


@settings(max_examples=150, deadline=None)
@given(points)
def test_changes_only_between_dates(pts):
    dates = [D0 + dt.timedelta(days=d) for d, _ in pts]
    got = _dp(dates, [v for _, v in pts])
    last = max(dates)
    assert all(d in dates and d != last for d in got)
    assert got == sorted(set(got))


def test_user_detector_errors_raise(spark):
    from salescp.operators.detect import detect

    df = spark.createDataFrame([("a", D0 + dt.timedelta(days=i), float(i)) for i in range(5)],
                               "key string, fecha date, value double")

    def broken(pdf):
        raise RuntimeError("boom")

    with pytest.raises(Exception, match="boom"):
        detect(df, ["key"], broken).collect()
