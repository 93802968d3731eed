"""Sums of doubles that do not depend on the order of the rows.

A double is cut in four whole numbers on a fixed grid of powers of 2**20:

    x = s0 * 2**(20 q) + s1 * 2**(20 (q - 1)) + s2 * 2**(20 (q - 2)) + s3 * 2**(20 (q - 3)),   q = floor(log2 |x| / 20)

which is exact (53 bits reach at most 73 bits below the top of the first slice).  Whole numbers add up
exactly in any order, in partial sums on the map side too; a long holds the slices of 2**43 rows.  What
the slices of a group add up to is put together once, from the largest power down with the rounding
errors kept (two-sum), so the result is the same for any partitioning, and all but always the double
nearest to the true sum.

Values that are not finite decide a group's sum as IEEE 754 does; nulls are left out, and a group of
nothing but nulls has a null sum.  Bits below 2**-1000 are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20  # of a slice
SLICES = 4
LOWEST = -47  # the least q


def _grid(q: Column) -> Column:
    return F.pow(F.lit(2.0), (q * BITS).cast("double"))  # exact: both whole, the power a double


def add_slices(df: DataFrame, value: Column, weight: Column | None = None) -> DataFrame:
    """`df` with _q, _s0 .. _s3 (times `weight`, a whole number), and _odd (the value if it is not finite)."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    x = F.when(finite, value).otherwise(0.0)
    q = F.when(x == 0.0, 0).otherwise(F.greatest(F.lit(LOWEST), F.floor(F.log2(F.abs(x)) / BITS))).cast("int")
    df = df.withColumn("_odd", F.when(value.isNotNull() & ~finite, value)).withColumn("_x", x).withColumn("_q", q)
    rest, times = F.col("_x"), F.lit(1).cast("long") if weight is None else weight.cast("long")
    for k in range(SLICES):
        unit = _grid(F.col("_q") - k)
        df = df.withColumn(f"_s{k}", F.floor(rest / unit)).withColumn("_x", rest - F.col(f"_s{k}") * unit)
        rest = F.col("_x")
    return df.withColumns({f"_s{k}": F.col(f"_s{k}") * times for k in range(SLICES)}).drop("_x")


def _together(parts: Column) -> Column:
    """The sum of array<struct<q, s0 .. s3>>, powers from the largest down, each long in two halves of 32 bits."""
    half = F.lit(1 << 32)

    def terms(p):
        out = []
        for k in range(SLICES):
            high = F.floor(p[f"s{k}"] / half)  # a long divided as doubles could round: only whole multiples are taken off below
            out += [F.struct((p["q"] - k).alias("g"), F.lit(0).alias("h"), (high * half).cast("double").alias("v")),
                    F.struct((p["q"] - k).alias("g"), F.lit(1).alias("h"), (p[f"s{k}"] - high * half).cast("double").alias("v"))]
        return F.array(*out)

    ordered = F.reverse(F.array_sort(F.flatten(F.transform(parts, terms))))

    def add(acc, t):
        x = t["v"] * _grid(t["g"])
        s = acc["s"] + x
        b = s - acc["s"]
        return F.struct(s.alias("s"), (acc["c"] + ((acc["s"] - (s - b)) + (x - b))).alias("c"))

    return F.aggregate(ordered, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add, lambda acc: acc["s"] + acc["c"])


def exact_sums(df: DataFrame, keys: Sequence[str], value: Column, name: str = "suma", weight: Column | None = None,
               rows: str | None = None) -> DataFrame:
    """(keys..., name[, rows]): per key the order-free sum of `value` (times `weight`), and how many values it has."""
    keys = list(keys)
    n = F.when(value.isNotNull(), F.lit(1).cast("long") if weight is None else weight.cast("long")).otherwise(0)
    cut = add_slices(df.select(*keys, value.alias("_v"), n.alias("_n"), (F.lit(1) if weight is None else weight).alias("_w")),
                     F.col("_v"), F.col("_w") if weight is not None else None)
    by_grid = cut.groupBy(*keys, "_q").agg(F.sum("_n").alias("_n"), F.sum("_odd").alias("_odd"),
                                           *[F.sum(f"_s{k}").alias(f"s{k}") for k in range(SLICES)])
    parts = F.collect_list(F.struct(F.col("_q").alias("q"), *[f"s{k}" for k in range(SLICES)]))  # at most 99 rows of the grid
    out = by_grid.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_odd").alias("_odd"), parts.alias("_parts"))
    total = F.when(F.col("_n") > 0, F.coalesce(F.col("_odd"), _together(F.col("_parts"))))
    return out.select(*keys, total.alias(name), *([F.col("_n").alias(rows)] if rows else []))
