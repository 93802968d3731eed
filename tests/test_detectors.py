import datetime as dt
import random

import pytest
import rules
from conftest import SF_ORACLE, SF_SMALL

from salescp.operators import conclude, divide, regression
from salescp.operators.detect import detect
from salescp.operators.edpelt import edpelt
from salescp.plans.queries import REGRESSION_KEYS, enriched
from salescp.operators.series import price_series

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def frame(spark, series, extra=False):
    rows = []
    for key, pts in series.items():
        for p in pts:
            rows.append((key, *p))
    schema = "key string, fecha date, value double" + (", clave_venta bigint" if extra else "")
    return spark.createDataFrame(rows, schema)


def test_regression_lines(spark):
    broken = [(day(i), float(i) if i < 10 else float(i) + 50.0) for i in range(20)]
    straight = [(day(i), 3.0 + 2.0 * i) for i in range(20)]
    one_side = [(day(0), float(v)) for v in (1, 2, 3, 4)] + [(day(i), 10.0 + i) for i in range(1, 6)]
    df = frame(spark, {"broken": broken, "straight": straight, "one_side": one_side})
    got = {}
    for r in regression.segmented_regression(df, ["key"]).collect():
        got.setdefault(r.key, []).append(r.change_point)
    assert day(9) in got["broken"]
    assert "straight" not in got
    assert day(0) not in got.get("one_side", [])


def test_regression_equals_direct_refits(spark):
    keys = REGRESSION_KEYS
    s = price_series(enriched(spark, SF_SMALL, "type"), keys)
    pts = {}
    for r in s.collect():
        pts.setdefault(tuple(r[k] for k in keys), []).append((r.fecha, r.value))
    got = {}
    for r in regression.segmented_regression(s, keys).collect():
        got.setdefault(tuple(r[k] for k in keys), []).append(r.change_point)
    for key, p in pts.items():
        expect = rules.regression_points([d for d, _ in p], [v for _, v in p])
        assert sorted(got.get(key, [])) == expect, key


def test_shared_dates_order_free_regression(spark):
    rng = random.Random(5)
    pts = [(day(rng.randrange(12)), float(rng.randrange(5)) + (8 if i > 30 else 0)) for i in range(60)]
    pts.sort(key=lambda p: p[0])
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(pts)
        df = frame(spark, {"a": pts}).repartition(4)
        results.append(sorted(r.change_point for r in regression.segmented_regression(df, ["key"]).collect()))
    assert results[0] == results[1] == results[2]
    d = [p[0] for p in pts]
    v = [p[1] for p in pts]
    assert results[0] == rules.regression_points(d, v)


def test_short_series_give_nothing(spark):
    df = frame(spark, {"one": [(day(0), 1.0)], "two": [(day(0), 1.0), (day(1), 5.0)],
                       "five": [(day(i), float(i % 2) * 9) for i in range(5)],
                       "six": [(day(i), 0.0 if i < 3 else 9.0) for i in range(6)]})
    got = {r.key for r in edpelt(df, ["key"]).collect()}
    assert got <= {"six"}
    assert not {r.key for r in regression.segmented_regression(df, ["key"]).collect()} & {"one", "two", "five"}


def test_ties_json_order(spark):
    res = spark.createDataFrame([
        ("c", day(3), "ok"), ("c", day(1), "ok"), ("c", day(3), "ok"), ("c", day(1), "ok"), ("c", day(2), "ok"),
        ("c", None, "timeout"), ("d", day(5), "ok"),
    ], "cat string, change_point date, status string")
    out = {r.cat: r.histogram for r in conclude.conclude(res, ["cat"]).collect()}
    assert out["c"] == '{"2024-01-02": 2, "2024-01-04": 2, "2024-01-03": 1, "Timeout": 1}'
    assert out["d"] == '{"2024-01-06": 1}'


def test_divide_finds_both_shifts(spark):
    rng = random.Random(2)
    pts = []
    for i in range(240):
        lvl = 0.0 if i < 80 else (6.0 if i < 160 else 2.0)
        pts.append((day(i // 2), lvl + rng.gauss(0, 0.5), 1000 + i))
    df = frame(spark, {"long": pts}, extra=True)
    result, p1 = divide.divide_pelt(df, ["key"], segments=8, with_phase1=True)
    got = sorted(r.change_point for r in result.collect())
    cands = {r.change_point for r in p1.collect() if r.status == "ok"}
    assert set(got) <= cands
    assert any(abs((d - day(39)).days) <= 2 for d in got)
    assert any(abs((d - day(79)).days) <= 2 for d in got)
    exact = sorted(r.change_point for r in edpelt(df.drop("clave_venta"), ["key"]).collect())
    d = [p[0] for p in pts]
    v = [p[1] for p in pts]
    assert rules.edpelt_total(d, v, got) >= rules.edpelt_total(d, v, exact) - 1e-9


def test_detect_dispatch_and_user_detector(spark):
    pts = [(day(i), 0.0 if i < 10 else 5.0) for i in range(20)]
    df = frame(spark, {"a": pts})
    assert [r.change_point for r in detect(df, ["key"], "edpelt").collect()] == [day(9)]
    assert day(9) in [r.change_point for r in detect(df, ["key"], "regression").collect()]

    def biggest_jump(pdf):
        jumps = pdf["mean"].diff().abs()
        return [pdf["fecha"].iloc[int(jumps.idxmax()) - 1]]

    assert [r.change_point for r in detect(df, ["key"], biggest_jump).collect()] == [day(9)]
    with pytest.raises(ValueError):
        detect(df, ["key"], "nope")


def test_user_detector_takes_many_keys_of_a_batch(spark):
    """Keys are walked batch by batch, not one exchange with Python for each; nulls, NaN and keys cut by a batch edge hold."""
    pts = [(k, x, day(i), float(i * i)) for k, x, n in
           [(None, 1.0, 3), (2**60 + 1, None, 9), (2**60 + 2, float("nan"), 9), (5, -0.0, 4), (5, 0.0, 6), (6, 1.0, 1), (None, None, 2)]
           for i in range(n)] + [(8, 1.0, None, 1.0), (8, 1.0, day(2), 4.0)]
    df = spark.createDataFrame(pts, "k bigint, x double, fecha date, value double")

    def spread(pdf):
        assert list(pdf.columns) == ["fecha", "n", "mean", "m2"] and list(pdf.index) == list(range(len(pdf)))
        known = pdf["fecha"].dropna()
        assert known.is_monotonic_increasing and not pdf["fecha"].iloc[:len(known)].isna().any()
        ends = known.iloc[[0, -1]] if len(pdf) % 2 else known.to_numpy(dtype="datetime64[ns]")[[0, -1]]
        return list(ends) if pdf["n"].sum() > 1 else []

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in (2, 4, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
            found = detect(df, ["k", "x"], spread)
            assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, (
                (k, x, day(i), "ok") for k, x, first, last in
                [(None, 1.0, 0, 2), (2**60 + 1, None, 0, 8), (2**60 + 2, None, 0, 8), (5, 0.0, 0, 5), (None, None, 0, 1), (8, 1.0, 2, 2)]
                for i in (first, last))))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    steps = found._jdf.queryExecution().toString()
    assert "MapInArrow" in steps and "FlatMapGroupsInPandas" not in steps


def test_range_ranks_give_same_changes(spark):
    s = price_series(enriched(spark, SF_SMALL, "brand"), ["categoria", "year"], extra=("clave_venta",))
    keys = ["categoria", "year"]
    win = sorted(map(tuple, edpelt(s.drop("clave_venta"), keys, rank_strategy="window").collect()))
    rng = sorted(map(tuple, edpelt(s.drop("clave_venta"), keys, rank_strategy="range").collect()))
    assert win == rng and win
    dw = sorted(map(tuple, divide.divide_pelt(s, keys, rank_strategy="window").collect()))
    dr = sorted(map(tuple, divide.divide_pelt(s, keys, rank_strategy="range").collect()))
    assert dw == dr


def test_empty_series_give_empty_results(spark):
    empty = spark.createDataFrame([], "key string, fecha date, value double, clave_venta bigint")
    assert edpelt(empty.drop("clave_venta"), ["key"]).collect() == []
    assert divide.divide_pelt(empty, ["key"]).collect() == []
    res = regression.segmented_regression(empty.drop("clave_venta"), ["key"])
    assert res.collect() == []
    out = conclude.conclude(res, ["key"])
    assert out.collect() == [] and out.columns == ["key", "histogram"]


def test_divide_on_fixture_subset_and_not_below_exact(spark):
    keys = ["categoria", "year"]
    s = price_series(enriched(spark, SF_ORACLE, "brand"), keys, extra=("clave_venta",))
    result, p1 = divide.divide_pelt(s, keys, with_phase1=True)
    got, cands, exact = {}, {}, {}
    for r in result.collect():
        got.setdefault((r.categoria, r.year), []).append(r.change_point)
    for r in p1.collect():
        cands.setdefault((r.categoria, r.year), set()).add(r.change_point)
    for r in edpelt(s.drop("clave_venta"), keys).collect():
        exact.setdefault((r.categoria, r.year), []).append(r.change_point)
    pts = {}
    for r in s.collect():
        pts.setdefault((r.categoria, r.year), []).append((r.fecha, r.value))
    assert got  # sf0.01 has divide-PELT changes (sf0.001 has none)
    for key, changes in got.items():
        assert set(changes) <= cands.get(key, set()), key
        d = [p[0] for p in pts[key]]
        v = [p[1] for p in pts[key]]
        assert rules.edpelt_total(d, v, changes) >= rules.edpelt_total(d, v, exact.get(key, [])) - 1e-9, key


def test_regression_right_side_of_one_heavy_date_is_not_flagged(spark):
    """39,237 points on one later date: centred sums leave a crumb where the spread is zero."""
    from pyspark.sql import functions as F

    line = spark.range(10).select(F.lit("k").alias("key"), F.expr("date_add(DATE'2000-01-01', cast(id as int))").alias("fecha"),
                                  (F.col("id") * 2.0 + 1).alias("value"))
    heavy = spark.range(39_237).select(F.lit("k").alias("key"), F.expr("DATE'2000-02-09'").alias("fecha"),
                                       F.expr("cast(id % 7 as double)").alias("value"))
    found = regression.segmented_regression(line.unionByName(heavy), ["key"]).collect()
    assert dt.date(2000, 1, 10) not in [r.change_point for r in found]


def test_a_timed_out_segment_times_out_its_key(spark):
    rng = random.Random(4)
    pts = {k: [(day(i // 2), (0.0 if i < 100 else 9.0) + rng.gauss(0, 0.5), 1000 + i) for i in range(200)] for k in "ab"}
    df = frame(spark, pts, extra=True)
    vcs = divide.segment_counts(df, ["key"])
    p1 = divide.phase1(vcs, df, ["key"]).collect()
    late = [(r.key, r.segmento, None, "timeout") if (r.key, r.segmento) == ("a", 3) else tuple(r) for r in p1]
    late += [] if any(r[3] == "timeout" for r in late) else [("a", 3, None, "timeout")]
    p1 = spark.createDataFrame(late, "key string, segmento int, change_point date, status string")
    out = divide.phase2(vcs, divide.candidates(p1, ["key"]), df, ["key"], late=divide.timed_out(p1, ["key"])).collect()
    assert [(r.change_point, r.status) for r in out if r.key == "a"] == [(None, "timeout")]
    assert [r.status for r in out if r.key == "b"] == ["ok"] * len([r for r in out if r.key == "b"]) != []


def test_divide_with_no_time_says_so(spark):
    df = frame(spark, {"a": [(day(i), float(i > 40), 1000 + i) for i in range(80)]}, extra=True)
    assert [(r.change_point, r.status) for r in divide.divide_pelt(df, ["key"], max_seconds=0).collect()] == [(None, "timeout")]


def test_phase_2_folds_dates_into_intervals(spark):
    from salescp.operators.edpelt import positions, threshold_histogram

    rng = random.Random(6)
    df = frame(spark, {"a": [(day(i), rng.gauss(0, 1) + (i > 60), 1000 + i) for i in range(120)]}, extra=True)
    vc = divide.segment_counts(df, ["key"]).groupBy("key", "fecha", "value").agg({"c": "sum"}).withColumnRenamed("sum(c)", "c")
    cands = spark.createDataFrame([("a", day(20)), ("a", day(60))], "key string, fecha date")
    hist = threshold_histogram(vc, positions(vc, ["key"]), ["key"])
    rows = divide.intervals(hist, cands, ["key"]).collect()
    assert {r.fecha for r in rows} == {day(20), day(60), dt.date(9999, 12, 31)}
    assert len(rows) <= 3 * (rows[0].k + 1)
    assert sum(r.cnt for r in rows) == 2 * 120
