import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from salescp.operators import aggregate as agg
from salescp.operators.enrich import DuplicateKeyError, enrich, join_side
from salescp.operators.series import price_series
from salescp.params import Filters
from salescp.sources import text

FILTERS = Filters(departments=("MONTEVIDEO", "CANELONES"), excluded_category="CENSURADO")


def write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_bad_rows_rejected_and_counted(spark, tmp_path):
    path = write(tmp_path, "ventas.txt", [
        "clave_local;clave_producto;fecha;cant;cant;precio;venta",  # header
        "12;345;2024-01-05;2;2;189.9;900001",
        "12;345;2024-01-06;2;2",  # short row
        "12;345;2024-01-07;2;dos;50;900003",  # text in cant_vta
        "12;345;2024-13-45;2;2;60;900004",  # bad date: kept here, dropped from the series
    ])
    parsed = text.read_ventas(spark, path)
    rows = parsed.rows.collect()
    assert sorted(r.clave_venta for r in rows) == [900001, 900004]
    assert parsed.counts() == {"lines": 5, "rejected": 3}
    series = price_series(parsed.rows.withColumn("k", F.lit(1)), ["k"])
    assert [r.fecha for r in series.collect()] == [dt.date(2024, 1, 5)]
    with pytest.raises(Exception, match=text.BAD_ROW):
        text.read_ventas(spark, path, strict=True).rows.collect()


def test_strict_reads_a_clean_table_once(spark, tmp_path):
    path = write(tmp_path, "clean.txt", ["12;345;2024-01-05;2;2;189.9;900001"])
    parsed = text.read_ventas(spark, path, strict=True)
    assert parsed.rows.count() == 1
    assert parsed.counts() == {"lines": 1, "rejected": 0}


def test_dimension_header_drops_only_that_line(spark, tmp_path):
    path = write(tmp_path, "productos.txt", ["categoria;clave", "REPELENTE;345", "INSECTICIDA;346"])
    parsed = text.read_productos(spark, path)
    assert sorted((r.categoria, r.clave) for r in parsed.rows.collect()) == [("INSECTICIDA", 346),
                                                                               ("REPELENTE", 345)]


def _star(spark):
    ventas = spark.createDataFrame([
        (1, 10, dt.date(2024, 1, 1), 1.0, 1.0, 9.99, 1),
        (1, 10, dt.date(2024, 1, 1), 1.0, 1.0, 10.0, 2),
        (1, 10, dt.date(2024, 1, 1), 1.0, 1.0, 2000.0, 3),
        (1, 10, dt.date(2024, 1, 1), 1.0, 1.0, 2000.01, 4),
        (1, 10, dt.date(2024, 1, 1), 1.0, 1.0, float("nan"), 5),
        (1, 10, dt.date(2024, 1, 1), -1.0, -1.0, 50.0, 6),
        (1, 10, dt.date(2024, 1, 1), 0.0, 0.0, 50.0, 7),
        (1, 10, dt.date(2024, 1, 1), float("nan"), 0.0, 50.0, 8),
        (1, 99, dt.date(2024, 1, 2), 2.0, 2.0, 50.0, 9),  # no product
        (7, 10, dt.date(2024, 1, 2), 3.0, 3.0, 50.0, 10),  # no store
        (1, 11, dt.date(2024, 1, 2), 4.0, 4.0, 50.0, 11),  # excluded category
        (2, 10, dt.date(2024, 1, 2), 5.0, 5.0, 50.0, 12),  # excluded department
    ], "clave_local bigint, clave_producto bigint, fecha date, cant_vta_original float, cant_vta float, "
       "precio_unitario float, clave_venta bigint")
    productos = spark.createDataFrame([("REPELENTE", 10), ("CENSURADO", 11)], "categoria string, clave bigint")
    locales = spark.createDataFrame([("MONTEVIDEO", 1), ("SALTO", 2)], "departamento string, clave bigint")
    return ventas, productos, locales


def test_bounds_and_nan(spark):
    v, p, l = _star(spark)
    got = sorted(r.clave_venta for r in enrich(v, p, l, "inner", FILTERS).collect())
    assert got == [2, 3, 7]


def test_unmatched_inner_vs_left(spark):
    v, p, l = _star(spark)
    left = {r.clave_venta: (r.categoria, r.departamento) for r in enrich(v, p, l, "left", FILTERS).collect()}
    assert left[9] == ("", "MONTEVIDEO")
    assert left[10] == ("REPELENTE", "")
    assert left[11] == ("", "MONTEVIDEO")
    assert left[12] == ("REPELENTE", "")
    q1 = {(r.categoria, r.departamento): r.cantidad for r in agg.quantity_by_cat_dep(v, p, l, FILTERS).collect()}
    assert q1 == {("REPELENTE", "MONTEVIDEO"): 0.0 + 1 + 1 + 0, ("", "MONTEVIDEO"): 6.0,
                  ("REPELENTE", ""): 8.0}


def test_duplicate_dimension_keys(spark):
    v, _, l = _star(spark)
    p = spark.createDataFrame([("A", 10), ("B", 10)], "categoria string, clave bigint")
    rows = enrich(v, p, l, "inner", Filters(("MONTEVIDEO",), None)).collect()
    assert {r.categoria for r in rows} == {"B"}
    assert len(rows) == 3
    with pytest.raises(DuplicateKeyError):
        enrich(v, p, l, "inner", Filters(("MONTEVIDEO",), None), strict=True)


def test_duplicate_keys_filter_before_or_after_the_pick(spark):
    """product 10 is CENSURADO and ALIMENTO, store 1 is SALTO and MONTEVIDEO."""
    v, _, _ = _star(spark)
    p = spark.createDataFrame([("CENSURADO", 10), ("ALIMENTO", 10)], "categoria string, clave bigint")
    l = spark.createDataFrame([("SALTO", 1), ("MONTEVIDEO", 1)], "departamento string, clave bigint")
    left = enrich(v.where("clave_venta = 2"), p, l, "left", FILTERS).first()
    assert (left.categoria, left.departamento) == ("ALIMENTO", "MONTEVIDEO")
    assert enrich(v.where("clave_venta = 2"), p, l, "inner", FILTERS).collect() == []  # the picks are filtered out


def test_aggregates(spark):
    df = spark.createDataFrame([("a", "x", -3.0), ("a", "x", -1.0), ("a", "y", 2.0), ("b", "x", 5.0)],
                               "k string, x string, y double")
    assert {(r.k, r.x): r.promedio for r in agg.average_by_subkey(df, "k", "x", "y").collect()} == {
        ("a", "x"): -2.0, ("a", "y"): 2.0, ("b", "x"): 5.0}
    assert {(r.k, r.x): r.cantidad for r in agg.count_by_subkey(df, "k", "x").collect()}[("a", "x")] == 2
    assert {r.k: r.maximo for r in agg.max_by_key(df, "k", "y").collect()} == {"a": 2.0, "b": 5.0}
    neg = df.filter(F.col("y") < 0)
    assert [r.maximo for r in agg.max_by_key(neg, "k", "y").collect()] == [-1.0]
    t = spark.createDataFrame([("a", "1.5"), ("a", "x"), ("b", "zz")], "k string, v string")
    assert {r.k: r.suma for r in agg.sum_values(t, "k", "v").collect()} == {"a": 1.5, "b": 0.0}
    assert math.isclose({r.k: r.suma for r in agg.sum_by_key(df, "k", "y").collect()}["a"], -2.0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_plans(spark):
    v, p, l = _star(spark)
    inner = enrich(v, p, l, "inner", FILTERS)
    inner.collect()
    assert "BroadcastHashJoin" in _plan(inner)
    left = enrich(v, p, l, "left", FILTERS, join_strategy="shuffle")
    left.collect()
    assert "SortMergeJoin" in _plan(left)
    with pytest.raises(ValueError):
        join_side(v, "broadcast", max_rows=3)


def test_text_sink_lines(spark):
    from salescp.sources.sinks import text_lines

    df = spark.createDataFrame(
        [("REPELENTE", None, dt.date(2024, 1, 5), [dt.date(2024, 1, 5), dt.date(2024, 2, 1)])],
        "categoria string, departamento string, fecha date, dates array<date>")
    line = text_lines(df, ["categoria", "departamento", "fecha"], ["dates"], sep=";").first().value
    assert line == "REPELENTE\tNULL\t2024-01-05;2024-01-05, 2024-02-01"
