import datetime as dt
import random

import numpy as np
import pytest
import rules

from salescp.operators import edpelt as E

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def dp_dates(dates, values, **kw):
    """Run the numpy DP on one in-memory series (tables built by the rules module)."""
    order = sorted(range(len(dates)), key=lambda i: dates[i])
    dates = [dates[i] for i in order]
    values = [float(values[i]) for i in order]
    k, _, Pl = rules.edpelt_tables(values)
    uniq = sorted(set(dates))
    ends = [max(i for i in range(len(dates)) if dates[i] == d) + 1 for d in uniq]
    tau = np.array([0] + ends)
    P = np.array([[Pl[i][t] for i in range(k)] for t in tau])
    found = E.solve(P, tau, k, **kw)
    return None if found is None else [uniq[b - 1] for b in found]


def test_golden_steps():
    dates = [day(i) for i in range(18)]
    values = [0] * 6 + [1] * 6 + [2] * 6
    assert dp_dates(dates, values) == [dates[5], dates[11]]
    assert rules.edpelt_points(dates, values) == [dates[5], dates[11]]


def _random_series(rng, n, shared):
    span = max(1, n // 2) if shared else n
    dates = [day(rng.randrange(span)) if shared else day(i) for i in range(n)]
    lvl = rng.choice([0, 5, 10])
    values = [round(rng.gauss(lvl + (3 if i > n // 2 else 0), 1), 1) for i in range(n)]
    return dates, values


@pytest.mark.parametrize("seed", range(40))
def test_dp_equals_exact_rules_and_brute_force(seed):
    rng = random.Random(seed)
    n = rng.randrange(3, 13)
    dates, values = _random_series(rng, n, shared=seed % 2 == 1)
    got = dp_dates(dates, values)
    assert got == rules.edpelt_points(dates, values)
    best = rules.edpelt_brute_cost(dates, values)
    assert rules.edpelt_total(dates, values, got) == pytest.approx(best, rel=1e-12, abs=1e-12)


def test_short_and_constant():
    assert dp_dates([day(0), day(1), day(2)], [1, 2, 3]) == []
    assert dp_dates([day(i) for i in range(5)], [0, 0, 0, 9, 9]) == []
    assert dp_dates([day(i) for i in range(30)], [4.5] * 30) == []


def test_time_budget():
    dates = [day(i) for i in range(18)]
    assert dp_dates(dates, [0] * 6 + [1] * 6 + [2] * 6, max_seconds=0) is None


def _spark_series(spark, series):
    rows = [(key, d, float(v)) for key, (dates, values) in series.items() for d, v in zip(dates, values)]
    return spark.createDataFrame(rows, "key string, fecha date, value double")


def test_spark_pipeline_matches_rules(spark):
    rng = random.Random(7)
    series = {}
    for s in range(30):
        n = rng.randrange(1, 80)
        series[f"s{s}"] = _random_series(rng, n, shared=s % 3 == 0)
    series["golden"] = ([day(i) for i in range(18)], [0] * 6 + [1] * 6 + [2] * 6)
    df = _spark_series(spark, series)
    got = {}
    for r in E.edpelt(df, ["key"]).collect():
        assert r.status == "ok"
        got.setdefault(r.key, []).append(r.change_point)
    for key, (dates, values) in series.items():
        assert sorted(got.get(key, [])) == rules.edpelt_points(dates, values), key
    assert sorted(got["golden"]) == [day(5), day(11)]


def test_spark_result_ignores_row_order(spark):
    rng = random.Random(3)
    dates, values = _random_series(rng, 60, shared=True)
    pts = list(zip(dates, values))
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(pts)
        df = _spark_series(spark, {"a": ([p[0] for p in pts], [p[1] for p in pts])}).repartition(5)
        results.append(sorted(r.change_point for r in E.edpelt(df, ["key"]).collect()))
    assert results[0] == results[1] == results[2]


def test_partial_sums_match_rules(spark):
    rng = random.Random(11)
    dates, values = _random_series(rng, 40, shared=True)
    df = _spark_series(spark, {"a": (dates, values)})
    vc = E.value_counts(df, ["key"])
    th = E.thresholds(vc, ["key"])
    ps = E.partial_sums(E.threshold_histogram(vc, E.positions(vc, ["key"]), ["key"]), th, ["key"]).collect()
    order = sorted(range(len(dates)), key=lambda i: dates[i])
    sd = [dates[i] for i in order]
    sv = [float(values[i]) for i in order]
    k, ts, P = rules.edpelt_tables(sv)
    assert len(ps) == k * len(set(dates))
    for r in ps:
        end = max(i for i in range(len(sd)) if sd[i] == r.fecha) + 1
        assert r.threshold == ts[r.i]
        assert r.partial_sum == P[r.i][end]


def test_timeout_status_row(spark):
    df = _spark_series(spark, {"g": ([day(i) for i in range(18)], [0] * 6 + [1] * 6 + [2] * 6)})
    rows = E.edpelt(df, ["key"], max_seconds=0).collect()
    assert [(r.change_point, r.status) for r in rows] == [(None, "timeout")]


@pytest.mark.parametrize("strategy", ["window", "range"])
def test_threshold_strategies_agree_with_rules(spark, strategy):
    rng = random.Random(21)
    series = {}
    for s in range(6):
        n = rng.randrange(3, 300) if s else 2000  # one hot key spanning many range partitions
        series[f"s{s}"] = _random_series(rng, n, shared=True)
    df = _spark_series(spark, series)
    vc = E.value_counts(df, ["key"])
    th = {r.key: r for r in E.thresholds(vc, ["key"], strategy=strategy, partitions=7).collect()}
    for key, (dates, values) in series.items():
        k, ts, _ = rules.edpelt_tables(sorted(float(v) for v in values))
        assert th[key].k == k and th[key].n == len(values)
        assert list(th[key].ts) == ts, key


@pytest.mark.parametrize("strategy", ["window", "range"])
def test_positions_are_counts_of_thresholds(spark, strategy):
    rng = random.Random(22)
    series = {f"s{s}": _random_series(rng, 60 * s + 3, shared=True) for s in range(5)}
    vc = E.value_counts(_spark_series(spark, series), ["key"])
    for r in E.positions(vc, ["key"], strategy=strategy, partitions=5).collect():
        _, ts, _ = rules.edpelt_tables(sorted(float(v) for v in series[r.key][1]))
        assert (r.a, r.b) == (sum(t <= r.value for t in ts), sum(t < r.value for t in ts))


def test_range_ranks_need_a_written_sort(spark):
    vc = E.value_counts(_spark_series(spark, {"a": ([day(0), day(1), day(2)], [1, 2, 3])}), ["key"])
    with pytest.raises(ValueError):
        E.positions(vc, ["key"], strategy="range", reuse="none")


@pytest.mark.parametrize("limit", [0, 10**9])
def test_both_forms_of_the_dp(monkeypatch, limit):
    monkeypatch.setattr(E, "PAIR_TABLE_LIMIT", limit)  # 0: pruned search, large: table of all pairs
    for seed in range(60):
        rng = random.Random(1000 + seed)
        dates, values = _random_series(rng, rng.randrange(3, 90), shared=seed % 2 == 1)
        assert dp_dates(dates, values) == rules.edpelt_points(dates, values)
