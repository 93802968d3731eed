"""ED-PELT under a work budget, and by blocks of dates."""

import datetime as dt
import math

import numpy as np
import pytest

from salescp.operators import edpelt as E
from salescp.operators import edpelt_blocks as B
from salescp.operators.detect import detect


def sums(rng, n_dates, per_date=3, levels=3):
    """(days, P, tau, k) of a random series whose level shifts now and then."""
    shift = np.cumsum(rng.random(n_dates) < 4 / n_dates) * rng.choice([0, 3, 8], 1)
    day, value = [], []
    for d in range(n_dates):
        m = int(rng.integers(1, per_date + 1))
        day += [d * int(rng.integers(1, 2))] * m
        value += list(np.round(rng.normal(shift[d], 1, m), 1 if levels > 1 else 0))
    day, value = np.array(day), np.array(value)
    n = len(value)
    k = int(min(n, math.ceil(4 * math.log(n))))
    z = -1 + (2 * np.arange(k) + 1) / k
    t = np.sort(value)[np.floor((n - 1) / (1 + (2 * n - 1.0) ** -z)).astype(int)]
    d, j, cnt = [], [], []
    for x, v in zip(day, value):
        for p in (int((t <= v).sum()), int((t < v).sum())):
            d.append(x), j.append(p), cnt.append(1)
    days, P, tau = E.boundary_sums(np.array(d), np.array(j), np.array(cnt, dtype=float), k)
    return days, P, tau, k


def cost_of(P, tau, k, changes):
    n = int(tau[-1])
    edges, factor = [0, *changes, len(tau) - 1], 2.0 * -math.log(2 * n - 1) / k
    return sum(float(E.segment_costs(P, tau, np.array([a]), b, factor)[0]) for a, b in zip(edges, edges[1:])) + 3 * math.log(n) * len(changes)


@pytest.mark.parametrize("seed", range(12))
def test_a_cut_search_brackets_the_optimum(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    if seed % 2:
        monkeypatch.setattr(E, "PAIR_TABLE_LIMIT", 0)  # the form with pruning
    _, P, tau, k = sums(rng, int(rng.integers(3, 60)))
    n_b = len(tau) - 1
    every = E.evaluations(tau, np.ones(n_b + 1, dtype=bool))
    plain = [sum(1 for a in range(b) if tau[b] - tau[a] >= 3 and (a == 0 or tau[a] >= 3)) for b in range(n_b + 1)]
    assert every.tolist() == plain
    best = E.solve(P, tau, k)
    optimum = cost_of(P, tau, k, best)
    found, used, complete, cost, low = E.solve_within(P, tau, k, 10 ** 9)
    assert (found, used, complete) == (best, sum(plain), True) and cost == low == pytest.approx(optimum)
    lows = []
    for budget in sorted({0, 1, *rng.integers(0, sum(plain) + 1, 12).tolist(), max(0, sum(plain) - 1)}):
        found, used, complete, cost, low = E.solve_within(P, tau, k, budget)
        assert used <= budget and complete == (sum(plain) <= budget)
        assert cost == pytest.approx(cost_of(P, tau, k, found))
        assert low <= optimum + 1e-9 and cost >= optimum - 1e-9
        lows.append(low)
    assert max(lows) <= optimum + 1e-9


def by_blocks(days, P, tau, k, size, min_points=3):
    """The stages of `run_blocks` and the way back, without Spark."""
    n, blocks = int(tau[-1]), []
    number = (days // size).tolist()
    for idx, block in enumerate(sorted(set(number))):
        at = [q + 1 for q, x in enumerate(number) if x == block]
        at, ds = ([0, *at], [B.ORIGIN]) if idx == 0 else (at, [])
        ds = np.array([*ds, *days[[q - 1 for q in at if q]]], dtype=np.int64)
        best = np.full(len(at), np.inf)
        made = B.Block(n, k, ds, tau[at], P[at], best, np.full(len(at), B.ORIGIN, dtype=np.int64), np.full(len(at), B.NEVER, dtype=np.int64))
        if idx == 0:
            best[0] = -made.penalty
        blocks.append(made)
    for j, source in enumerate(blocks):
        source.close(min_points)
        for later in blocks[j + 1:]:
            later.relax(source, min_points)
    start = {int(d): int(p) for b in blocks for d, p in zip(b.days, b.prev)}
    cur, out = int(blocks[-1].prev[-1]), []
    while cur != B.ORIGIN:
        out.append(cur)
        cur = start[cur]
    return out[::-1]


@pytest.mark.parametrize("seed", range(10))
def test_blocks_equal_the_whole_program(seed, monkeypatch):
    rng = np.random.default_rng(100 + seed)
    monkeypatch.setattr(E, "PAIR_TABLE_LIMIT", rng.choice([0, 2_000_000]))
    days, P, tau, k = sums(rng, int(rng.integers(3, 150)))
    expect = [int(days[b - 1]) for b in E.solve(P, tau, k)]
    for size in (1, 7, 40, 1000):
        assert by_blocks(days, P, tau, k, size) == expect


def frame(spark, rng, keys):
    rows = []
    for key in keys:
        for _, (d, v) in enumerate(zip(rng.integers(0, 200, 300), rng.normal(0, 1, 300))):
            rows.append((key, dt.date(2020, 1, 1) + dt.timedelta(days=int(d)), float(round(v + 6 * (d > 90) - 4 * (d > 140), 1))))
    rows += [("short", dt.date(2020, 1, 1), 1.0), ("short", dt.date(2020, 1, 2), 2.0), ("flat", dt.date(2020, 2, 1), 5.0)]
    return spark.createDataFrame(rows, "g string, fecha date, value double")


def test_blocks_on_spark_equal_edpelt(spark):
    s = frame(spark, np.random.default_rng(1), ["a", "b", "c"])
    expect = sorted(map(tuple, E.edpelt(s, ["g"]).collect()))
    assert len({r[0] for r in expect}) == 3
    for size in (13, 50, 10_000):
        assert sorted(map(tuple, B.edpelt_blocks(s, ["g"], block_days=size).collect())) == expect
    assert B.edpelt_blocks(s.limit(0), ["g"]).collect() == []


def test_no_task_of_the_blocks_holds_a_series(spark):
    s = frame(spark, np.random.default_rng(2), ["a"])
    hist, _ = E._folded(s, ["g"], "table", "auto")
    blocks = B.blocks_of(hist, ["g"], 20, E.result_schema(s, ["g"])).collect()
    dates = [len(np.frombuffer(r.days, dtype="<i8")) for r in blocks]
    assert len(blocks) == blocks[0].blocks > 9 and max(dates) <= 21  # boundary 0 lies in the first block
    assert sum(dates) == s.where("g = 'a'").select("fecha").distinct().count() + 1


def test_a_budget_gives_a_row_per_cut_series(spark):
    s = frame(spark, np.random.default_rng(3), ["a", "b"])
    rows = {r.g: r for r in E.edpelt_within(s, ["g"], 500).collect()}
    assert set(rows) == {"a", "b"} and all(r.status == "cut" and r.evaluations <= 500 and r.lower_bound <= r.cost for r in rows.values())
    again = {r.g: r for r in E.edpelt_within(s.repartition(7), ["g"], 500).collect()}
    assert again == rows  # work, not time: the same rows in any run
    got = detect(s, ["g"], "edpelt", max_evaluations=500).collect()
    assert {r.g for r in got} == {"a", "b"} and {r.status for r in got} == {"cut"}
    none = detect(s, ["g"], "edpelt", max_evaluations=0).collect()
    assert sorted((r.g, r.change_point, r.status) for r in none) == [("a", None, "cut"), ("b", None, "cut")]
    full = detect(s, ["g"], "edpelt", max_evaluations=10 ** 9)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, E.edpelt(s, ["g"]).collect()))
    with pytest.raises(ValueError):
        E.edpelt(s, ["g"], max_seconds=1, max_evaluations=1)
