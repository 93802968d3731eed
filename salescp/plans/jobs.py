"""End-to-end jobs over the native text tables, one per entry point of the original.

    python -m salescp <job> VENTAS PRODUCTOS LOCALES OUT [options]

jobs:
    reduce-join-sum   total quantity per (category, department), left joins
    hash-join-sum     sum of unit price per day by (category, department, year)
    pelt              ED-PELT per series, then the histogram roll-up
    regression        segmented regression per series, then the roll-up
    divide            divide-PELT per series, then the roll-up

Detector jobs write OUT/detections (`key<TAB>...;d1, d2` lines, `Timeout`
for a series out of time) and OUT/conclusions (one small file of
`key<TAB>{json}` lines); `--format parquet` writes the long tables instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_text, joined_text
from ..operators import aggregate as agg
from ..operators.conclude import conclude
from ..operators.detect import detect
from ..operators.enrich import enrich
from ..operators.series import price_series
from ..params import (DEFAULT_DEPARTMENTS, DEFAULT_EXCLUDED_CATEGORY, MAX_SECONDS_PER_SERIES, TIMEOUT_TOKEN,
                      Filters)
from ..session import configure, drop_materialized, materialize, scratch
from ..sources import sinks, text

DEFAULT_KEY = ("categoria", "year", "clave_producto")
DETECTORS = {"pelt": "edpelt", "regression": "regression", "divide": "divide"}


def detections_text(result: DataFrame, key_cols) -> DataFrame:
    """One line per series with changes: key fields, then `;`, then the dates."""
    token = F.when(F.col("status") == "timeout", F.lit(TIMEOUT_TOKEN)).otherwise(date_text("change_point"))
    per_key = result.groupBy(*key_cols).agg(F.array_sort(F.collect_list(token)).alias("dates"))
    return per_key.select(*key_cols, joined_text("dates").alias("dates"))


def run(spark: SparkSession, job: str, ventas_path: str, productos_path: str, locales_path: str, out: str,
        filters: Filters = Filters(), key_cols=DEFAULT_KEY, fmt: str = "text",
        max_seconds: float | None = None, strict: bool = False) -> dict:
    configure(spark)
    ventas = text.read_ventas(spark, ventas_path, strict)
    productos = text.read_productos(spark, productos_path, strict).rows
    locales = text.read_locales(spark, locales_path, strict).rows
    v = ventas.rows
    if job == "reduce-join-sum":
        res = agg.quantity_by_cat_dep(v, productos, locales, filters)
        _write(res, out, ["categoria", "departamento"], ["cantidad"], fmt)
    elif job == "hash-join-sum":
        res = agg.daily_price_by_cat_dep_year(v, productos, locales, filters)
        _write(res, out, ["categoria", "departamento", "year", "fecha"], ["suma_precio"], fmt)
    elif job in DETECTORS:
        keys = list(key_cols)
        extra = ("clave_venta",) if job == "divide" else ()
        enriched = agg.with_year(enrich(v, productos, locales, "inner", filters, strict=strict))
        series = price_series(enriched, keys, extra=extra)
        # small result, two sinks: write it once rather than run the detector twice
        result = materialize(detect(series, keys, DETECTORS[job], max_seconds=max_seconds))
        rollup = [c for c in keys if c not in ("clave_producto", "clave_local")]
        if fmt == "parquet":
            sinks.write_parquet(result, f"{out}/detections")
            sinks.write_parquet(conclude(result, rollup), f"{out}/conclusions")
        else:
            sinks.write_text(detections_text(result, keys), f"{out}/detections", keys, ["dates"], sep=";")
            sinks.write_text(conclude(result, rollup), f"{out}/conclusions", rollup, ["histogram"],
                             single_file=True)
    else:
        raise ValueError(f"unknown job {job!r}")
    return ventas.counts()


def _write(df: DataFrame, out: str, keys, values, fmt: str) -> None:
    if fmt == "parquet":
        sinks.write_parquet(df, out)
    else:
        sinks.write_text(df, out, keys, values)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="salescp", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=["reduce-join-sum", "hash-join-sum", *DETECTORS])
    ap.add_argument("ventas")
    ap.add_argument("productos")
    ap.add_argument("locales")
    ap.add_argument("out")
    ap.add_argument("--departments", default=",".join(DEFAULT_DEPARTMENTS))
    ap.add_argument("--exclude", default=DEFAULT_EXCLUDED_CATEGORY)
    ap.add_argument("--key", default=",".join(DEFAULT_KEY), help="series key columns")
    ap.add_argument("--format", default="text", choices=["text", "parquet"])
    ap.add_argument("--max-seconds", type=float, default=None,
                    help="time budget per series; a series over it gives Timeout (default: none; the original's is "
                         f"{MAX_SECONDS_PER_SERIES})")
    ap.add_argument("--strict", action="store_true", help="fail on the first bad line or duplicate key")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"salescp-{a.job}").getOrCreate()
    filters = Filters(tuple(x for x in a.departments.split(",") if x), a.exclude or None)
    with scratch() as written:
        counts = run(spark, a.job, a.ventas, a.productos, a.locales, a.out, filters, a.key.split(","), a.format,
                     a.max_seconds, a.strict)
    drop_materialized(spark, written)  # outputs are written; the intermediate tables are no longer read
    print(f"ventas lines: {counts.get('lines')}, rejected: {counts.get('rejected')}")
