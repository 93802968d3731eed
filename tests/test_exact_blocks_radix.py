"""Order-free sums, the two-level regression scan and positions by histogram refinement."""

import datetime as dt
import math
import random
import re
import struct

import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from salescp.functions.exact import exact_sums
from salescp.operators import aggregate as agg
from salescp.operators import edpelt as E
from salescp.operators.regression import segmented_regression, split_errors


def bits(x):
    return None if x is None else struct.pack("<d", x)


def doubles(rng, n):
    out = []
    for _ in range(n):
        x = rng.choice([rng.gauss(0, 1), rng.random() * 10.0 ** rng.randint(-30, 30), -rng.random() * 2.0 ** rng.randint(-200, 60),
                        float(rng.randint(-10 ** 15, 10 ** 15)), 0.1, -0.1, 2.0 ** rng.randint(-60, 60), 0.0, -0.0, 1e300, -1e300])
        out.append(x)
    return out


def test_sums_are_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(k % 7, x) for k, x in enumerate(doubles(rng, 4000))] + [(8, 1e16), (8, 1.0), (8, -1e16), (9, None), (10, 5.0), (10, None)]
    got = []
    for parts in (1, 3, 50):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
        got.append({r.g: (bits(r.suma), r.n) for r in exact_sums(df, ["g"], F.col("v"), rows="n").collect()})
    assert got[0] == got[1] == got[2]
    for g in range(7):
        values = [x for k, x in rows if k == g and x is not None]
        assert got[0][g] == (bits(math.fsum(values)), len(values))  # the double nearest to the true sum
    assert got[0][8] == (bits(1.0), 3) and got[0][9] == (None, 0) and got[0][10] == (bits(5.0), 1)
    plain = spark.createDataFrame([(1e16,), (1.0,), (-1e16,)], "v double").coalesce(1).agg(F.sum("v")).first()[0]
    assert plain == 0.0  # what a sum in row order gives


def test_values_that_are_not_finite_decide_and_small_ones_survive(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("inf", inf), ("inf", 1.0), ("mixed", inf), ("mixed", -inf), ("nan", nan), ("nan", 2.0), ("least", 5e-280), ("least", 5e-280)]
    got = {r.g: r.suma for r in exact_sums(spark.createDataFrame(rows, "g string, v double"), ["g"], F.col("v")).collect()}
    assert got["inf"] == inf and math.isnan(got["mixed"]) and math.isnan(got["nan"]) and got["least"] == 1e-279
    assert exact_sums(spark.createDataFrame([], "g string, v double"), ["g"], F.col("v")).collect() == []


def test_weights_count_a_value_several_times(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 100), rng.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "v double, c bigint")
    got = exact_sums(df, [], F.col("v"), weight=F.col("c"), rows="n").first()
    assert got.suma == math.fsum(v for v, c in rows for _ in range(c)) and got.n == sum(c for _, c in rows)


def test_aggregates_with_exact_sums(spark):
    rows = [("a", "x", 0.1, "0.1")] * 10 + [("a", "y", 1e16, "z"), ("a", "y", 1.0, "1"), ("a", "y", -1e16, None)]
    df = spark.createDataFrame(rows, "g string, x string, v double, t string")
    one = lambda out: sorted(map(tuple, out.collect()))
    assert one(agg.sum_by_subkey(df, "g", "x", "v", exact=True)) == [("a", "x", math.fsum([0.1] * 10)), ("a", "y", 1.0)]
    assert one(agg.sum_by_key(df, "g", "v", exact=True)) == [("a", math.fsum([0.1] * 10 + [1.0]))]
    assert one(agg.average_by_subkey(df, "g", "x", "v", exact=True)) == [("a", "x", math.fsum([0.1] * 10) / 10), ("a", "y", 1.0 / 3)]
    assert one(agg.sum_values(df, "x", "t", exact=True)) == [("x", math.fsum([0.1] * 10)), ("y", 1.0)]
    plan = agg.sum_by_key(df, "g", "v", exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan


def long_series(spark, seed, days=900):
    rng = random.Random(seed)
    rows = []
    for g in ("a", "b", None):
        for _ in range(1500):
            d = rng.randrange(days)
            rows.append((g, dt.date(2015, 1, 1) + dt.timedelta(days=d), rng.gauss(50 + (40 if d > 500 else 0) + d / 40, 5)))
    rows += [("one", dt.date(2015, 1, 1), 1.0), ("two", dt.date(2015, 1, 1), 1.0), ("two", dt.date(2015, 9, 1), 1.0)]
    return spark.createDataFrame(rows, "g string, fecha date, value double")


def test_block_scan_equals_one_window(spark):
    s = long_series(spark, 1)
    key = lambda r: (r.g or "", r.fecha)
    expect = sorted(split_errors(s, ["g"]).collect(), key=key)
    for size in (1, 37, 5000):
        got = sorted(split_errors(s, ["g"], block_days=size).collect(), key=key)
        assert len(got) == len(expect)
        for x, y in zip(got, expect):
            assert (x.g, x.fecha, x.n_left, x.n_right) == (y.g, y.fecha, y.n_left, y.n_right)
            for c in ("sse_left", "sse_right", "sse_whole"):
                assert (x[c] is None) == (y[c] is None) and (x[c] is None or x[c] == pytest.approx(y[c], rel=1e-7, abs=1e-6))
    flags = sorted(map(str, segmented_regression(s, ["g"]).collect()))
    assert flags and flags == sorted(map(str, segmented_regression(s, ["g"], block_days=37).collect()))


def test_no_window_of_the_block_scan_holds_a_series(spark):
    plan = split_errors(long_series(spark, 2), ["g"], block_days=30)._jdf.queryExecution().analyzed().toString()
    wide = [w for w in re.findall(r"windowspecdefinition\(([^()]*)", plan) if "block" not in w.split(" ASC")[0].rsplit(",", 1)[0]]
    lines = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert lines and wide
    for line in lines:  # a window of a whole key is over rows of whole blocks
        for spec in re.findall(r"sum\((\w+)#\d+[^()]*\) windowspecdefinition\(([^()]*)", line):
            name, where = spec
            assert name.startswith("blk_") or where.count("block#") == 1 and "fecha#" in where


def test_regression_from_exact_sums_is_the_same_bits(spark):
    s, seen = long_series(spark, 3), []
    for parts in (1, 3, 50):
        rows = split_errors(s.repartition(parts), ["g"], exact=True).collect()
        seen.append(sorted((r.g or "", r.fecha, *(bits(r[c]) for c in ("sse_left", "sse_right", "sse_whole"))) for r in rows))
    assert seen[0] == seen[1] == seen[2]
    plain = {(r.g, r.fecha): r for r in split_errors(s, ["g"]).collect()}
    for r in split_errors(s, ["g"], exact=True).collect():
        assert r.sse_whole is None or r.sse_whole == pytest.approx(plain[r.g, r.fecha].sse_whole, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("seed", range(3))
def test_radix_positions_equal_both_rankings(spark, seed):
    rng, rows = random.Random(seed), []
    for g in range(6):
        pool = rng.choice([[0.0, -0.0, 1.0], [rng.gauss(0, 1) for _ in range(400)], [float(x) for x in range(-50, 50)],
                           [rng.random() * 10.0 ** rng.randint(-20, 20) * rng.choice([1, -1]) for _ in range(200)],
                           [100 + k * 2.0 ** -40 for k in range(300)]])
        rows += [(g, dt.date(2020, 1, 1 + k % 28), rng.choice(pool)) for k in range(rng.choice([2, 3, 50, 700]))]
    vc = E.value_counts(spark.createDataFrame(rows, "g int, fecha date, value double"), ["g"])
    got = [sorted(map(tuple, E.positions(vc, ["g"], s).select("g", "value", "n", "k", "a", "b").collect()))
           for s in ("radix", "window", "range")]
    assert got[0] == got[1] == got[2] and got[0]


def test_radix_positions_sort_no_values(spark):
    s = spark.read.parquet(f"{SF_ORACLE}/events.parquet").select("event_type", F.col("ts").cast("date").alias("fecha"), "value")
    vc = E.value_counts(s, ["event_type"])
    plan = E.positions(vc, ["event_type"], "radix")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Sort \[[^\]]*value#", plan)
    assert re.search(r"Sort \[[^\]]*value#", E.positions(vc, ["event_type"], "window")._jdf.queryExecution().executedPlan().toString())
