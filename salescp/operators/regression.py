"""Segmented regression with window sums only.

For a date-sorted series, every split between two distinct dates is tried:
left = all points dated <= d, right = the rest.  Each side gets a least-squares
line; a side with fewer than `min_points` points has infinite error.  The
split is flagged, and d reported, when left + right error < ratio * error of
one line over the whole series.  All flagged splits are reported.

Because a split always takes whole dates, the errors depend only on per-date
statistics.  One `groupBy(key, fecha)` and one prefix window per key give every
split in linear time; a key's window holds its dates, never its raw rows.

For keys of very many dates (`block_days`) the scan has two levels: sums of whole
blocks of calendar days, prefix and suffix sums over a key's blocks (a row each),
and windows inside a block; no window then holds more than a block's dates or a
key's blocks.

Numerics: x = days since the key's first date; y is centred on the key mean
and each date contributes its stable within-date deviation `m2`, so
    sse = Syy - Sxy^2 / Sxx   (all centred)
has no large-magnitude cancellation.  The left side comes from a prefix and the
right side from a suffix window, neither from a difference of totals.  A side
whose points share one date, by its number of dates, gives NULL (never
flagged).  A whole series with error at rounding
level (an exact line) flags nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import MIN_POINTS, REGRESSION_RATIO
from ..session import materialize
from .series import daily_stats, exact_daily_stats

# Whole-series error at or below this share of the centred sum of squares is
# rounding noise (an exact line): nothing is flagged then.
NOISE_SHARE = 1e-9


def _sse(dates, n, sx, sxx, sy, sxy, syy):
    # try_divide: an empty side (n = 0) gives NULL instead of an ANSI error
    sxx_c = sxx - F.try_divide(sx * sx, n)
    sxy_c = sxy - F.try_divide(sx * sy, n)
    syy_c = syy - F.try_divide(sy * sy, n)
    return F.when(dates > 1, syy_c - F.try_divide(sxy_c * sxy_c, sxx_c)), syy_c


ALL = (Window.unboundedPreceding, Window.unboundedFollowing)
BEFORE = (Window.unboundedPreceding, -1)
UP_TO = (Window.unboundedPreceding, 0)
AFTER = (1, Window.unboundedFollowing)


def _parts():
    """What is summed on each side of a split, from a date's c, x, md (mean less the key's mean) and m2."""
    c, x, md = F.col("c").cast("double"), F.col("x"), F.col("md")
    return {"dates": F.lit(1), "n": c, "sx": c * x, "sxx": c * x * x, "sy": c * md, "sxy": c * x * md,
            "syy": F.col("m2") + c * md * md}


def _sides(d: DataFrame, keys: list[str]) -> DataFrame:
    """(key..., fecha, l_*, r_*, t_*): sums left of each split (its date included), right of it, and of the key."""
    w = lambda frame: Window.partitionBy(*keys).orderBy("fecha").rowsBetween(*frame)
    first = F.min("fecha").over(w(ALL))
    key_mean = F.sum(F.col("c") * F.col("mean_d")).over(w(ALL)) / F.sum("c").over(w(ALL))
    d = d.select(*keys, "fecha", "c", "m2", F.datediff("fecha", first).cast("double").alias("x"),
                 (F.col("mean_d") - key_mean).alias("md"))
    sums = [F.coalesce(F.sum(e).over(w(frame)), F.lit(0)).alias(f"{side}_{p}")
            for side, frame in (("l", UP_TO), ("r", AFTER), ("t", ALL)) for p, e in _parts().items()]
    return d.select(*keys, "fecha", *sums)


def _at_block(dates: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Dates with their block's columns; null keys meet too."""
    named = blocks.toDF(*(f"_{c}" if c in (*keys, "block") else c for c in blocks.columns))
    return dates.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "block")]).drop(*(f"_{c}" for c in (*keys, "block")))


def _sides_by_blocks(d: DataFrame, keys: list[str], block_days: int, reuse: str) -> DataFrame:
    """`_sides` by a two-level scan; columns that start with `blk` are of whole blocks."""
    d = materialize(d.withColumn("block", F.floor(F.datediff("fecha", F.lit("1970-01-01").cast("date")) / block_days)), reuse)
    of_key = Window.partitionBy(*keys).orderBy("block")
    blocks = d.groupBy(*keys, "block").agg(F.min("fecha").alias("blk_first"), F.sum("c").alias("blk_c"),
                                           F.sum(F.col("c") * F.col("mean_d")).alias("blk_y"))
    blocks = blocks.select(*keys, "block", F.min("blk_first").over(of_key.rowsBetween(*ALL)).alias("first"), (
        F.sum("blk_y").over(of_key.rowsBetween(*ALL)) / F.sum("blk_c").over(of_key.rowsBetween(*ALL))).alias("key_mean"))
    d = _at_block(d, blocks, keys).select(*keys, "block", "fecha", "c", "m2", F.datediff("fecha", "first").cast("double").alias("x"),
                                          (F.col("mean_d") - F.col("key_mean")).alias("md"))
    sums = d.groupBy(*keys, "block").agg(*[F.sum(e).alias(f"blk_{p}") for p, e in _parts().items()])
    sums = sums.select(*keys, "block", *[
        F.coalesce(F.sum(f"blk_{p}").over(of_key.rowsBetween(*frame)), F.lit(0)).alias(f"{side}_{p}")
        for side, frame in (("before", BEFORE), ("after", AFTER), ("t", ALL)) for p in _parts()])
    inside = Window.partitionBy(*keys, "block").orderBy("fecha")
    return _at_block(d, sums, keys).select(
        *keys, "fecha",
        *[(F.col(f"before_{p}") + F.sum(e).over(inside.rowsBetween(*UP_TO))).alias(f"l_{p}") for p, e in _parts().items()],
        *[(F.col(f"after_{p}") + F.coalesce(F.sum(e).over(inside.rowsBetween(*AFTER)), F.lit(0))).alias(f"r_{p}")
          for p, e in _parts().items()],
        *[f"t_{p}" for p in _parts()])


def split_errors(series: DataFrame, key_cols: Sequence[str], block_days: int | None = None, exact: bool = False,
                 reuse: str = "table") -> DataFrame:
    """Per (key, split date d), point counts and fit errors of left, right and whole.

    `block_days`: two-level scan by blocks of that many calendar days; `exact`: per-date statistics from order-free
    sums, so that the errors are the same bits for any partitioning.
    """
    keys = list(key_cols)
    d = exact_daily_stats(series, keys, reuse) if exact else daily_stats(series, keys)
    d = _sides(d, keys) if block_days is None else _sides_by_blocks(d, keys, block_days, reuse)
    left, _ = _sse(*(F.col(f"l_{p}") for p in _parts()))
    right, _ = _sse(*(F.col(f"r_{p}") for p in _parts()))
    whole, whole_syy = _sse(*(F.col(f"t_{p}") for p in _parts()))
    return d.select(
        *keys, "fecha",
        F.col("l_n").cast("long").alias("n_left"),
        F.col("r_n").cast("long").alias("n_right"),
        left.alias("sse_left"), right.alias("sse_right"), whole.alias("sse_whole"),
        whole_syy.alias("syy_whole"),
    )


def segmented_regression(series: DataFrame, key_cols: Sequence[str], ratio: float = REGRESSION_RATIO,
                         min_points: int = MIN_POINTS, block_days: int | None = None, exact: bool = False) -> DataFrame:
    """Flagged splits, (key..., change_point date, status 'ok'), one row per flag (options: see `split_errors`)."""
    e = split_errors(series, key_cols, block_days, exact)
    flagged = e.filter(
        (F.col("n_left") >= min_points) & (F.col("n_right") >= min_points)
        & (F.col("n_left") + F.col("n_right") >= min_points)
        & (F.col("sse_whole") > F.lit(NOISE_SHARE) * F.col("syy_whole"))
        & (F.col("sse_left") + F.col("sse_right") < F.lit(ratio) * F.col("sse_whole"))
    )
    return flagged.select(*key_cols, F.col("fecha").alias("change_point"), F.lit("ok").alias("status"))
