"""Price series: one point per sale, keyed by a chosen list of columns.

A series is never collected.  It stays a DataFrame of (key..., fecha, value)
rows, and the detectors reduce it to one row per (key, date) with Spark
aggregates before any window or grouped-map step, so the work per key is
bounded by its number of distinct dates, not by its number of sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_date, widen_float
from ..functions.exact import exact_sums
from ..session import materialize


def price_series(enriched: DataFrame, key_cols: Sequence[str], date_col: str = "fecha",
                 value_col: str = "precio_unitario", extra: Sequence[str] = ()) -> DataFrame:
    """(key..., fecha date, value double[, extra...]); points with a bad date or value are dropped.

    The value is the unit price as a float widened to double, as the points of
    the original series are.
    """
    value = widen_float(value_col) if dict(enriched.dtypes)[value_col] in ("float", "string") \
        else F.col(value_col).cast("double")
    out = enriched.select(*key_cols, as_date(enriched, date_col).alias("fecha"), value.alias("value"), *extra)
    return out.filter(F.col("fecha").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))


def daily_stats(series: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Per (key, date): point count, mean and within-date squared deviation.

    `m2` comes from Spark's central-moment aggregate (numerically stable), so
    later prefix sums only deal with date means, not raw squares.
    """
    return series.groupBy(*key_cols, "fecha").agg(
        F.count(F.lit(1)).alias("c"),
        F.avg("value").alias("mean_d"),
        (F.var_pop("value") * F.count(F.lit(1))).alias("m2"),
    )


def exact_daily_stats(series: DataFrame, key_cols: Sequence[str], reuse: str = "table") -> DataFrame:
    """`daily_stats` from order-free sums: the same bits for any partitioning of the series.

    The points are folded to (key, date, value) -> count and written; the mean comes from one exact sum over
    them, and the squared deviations, each a function of its value and the mean, from another.
    """
    keys = [*key_cols, "fecha"]
    folded = materialize(series.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c")), reuse)
    means = exact_sums(folded, keys, F.col("value"), "_sum", weight=F.col("c"), rows="c").select(
        *(F.col(k).alias(f"_{k}") for k in keys), F.col("c").alias("_c"), (F.col("_sum") / F.col("c")).alias("mean_d"))
    off = folded.join(means, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).withColumn("_off", F.col("value") - F.col("mean_d"))
    spread = exact_sums(off.withColumn("_m", F.struct("mean_d", F.col("_c").alias("n"))), [*keys, "_m"],
                        F.col("_off") * F.col("_off"), "m2", weight=F.col("c"))
    return spread.select(*keys, F.col("_m.n").alias("c"), F.col("_m.mean_d").alias("mean_d"), "m2")
