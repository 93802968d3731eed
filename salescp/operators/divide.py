"""Divide-PELT: ED-PELT on segments of each series, then once more on candidates only.

Phase 1 splits every series into `segments` sub-series by
`pmod(clave_venta, segments)` (repeatable, no shuffle of its own) and runs
ED-PELT on each (key, segment): many small groups instead of one long one.
The union of the dates they report is the candidate set of the key.

Phase 2 runs ED-PELT on all points of the key (segments that found nothing
still contribute their points), with a change allowed only right after a
candidate date.  The dates between two candidates are folded into one interval
first, so its DP gets at most (candidates + 1) x (k + 1) rows per key.

A key of which a segment ran out of its time budget has no full candidate set:
it gives one row with status 'timeout' instead of dates.

Both phases read one materialized table of folded points
(key, segment, fecha, value, count), so the fact table is scanned once; the
phase-1 result is written too, since candidates and time-outs both read it.
Phase 2's positions and histogram need no candidate: they are made while phase 1
runs, so only its folding into intervals and its program wait for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import DIVIDE_SEGMENTS, MIN_POINTS
from ..session import materialize, side_by_side
from .edpelt import folded_histogram, result_schema, run_dp

SEGMENT = "segmento"


def segment_counts(series: DataFrame, key_cols: Sequence[str], segments: int = DIVIDE_SEGMENTS,
                   sale_col: str = "clave_venta") -> DataFrame:
    """(key..., segmento, fecha, value, c), folded points with their segment number."""
    seg = series.withColumn(SEGMENT, F.pmod(F.col(sale_col), F.lit(segments)).cast("int"))
    return seg.groupBy(*key_cols, SEGMENT, "fecha", "value").agg(F.count(F.lit(1)).alias("c"))


def phase1(vcs: DataFrame, series: DataFrame, key_cols: Sequence[str], min_points: int = MIN_POINTS,
           max_seconds: float | None = None, reuse: str = "table", known_rows: int | None = None,
           rank_strategy: str = "auto") -> DataFrame:
    """ED-PELT per (key, segment), (key..., segmento, change_point, status)."""
    skeys = list(key_cols) + [SEGMENT]
    vc = vcs.select(*skeys, "fecha", "value", "c")
    hist, placed = folded_histogram(vc, known_rows, skeys, reuse, rank_strategy)
    schema = result_schema(series.withColumn(SEGMENT, F.lit(0).cast("int")), skeys)
    return run_dp(hist, skeys, schema, min_points, max_seconds, placed=placed)


def candidates(phase1_result: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Distinct candidate dates per key (a timed-out segment has none; see `timed_out`)."""
    return phase1_result.filter(F.col("status") == "ok").select(
        *key_cols, F.col("change_point").alias("fecha")).distinct()


def timed_out(phase1_result: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys of which a segment ran out of time."""
    return phase1_result.filter(F.col("status") == "timeout").select(*key_cols).distinct()


def segment_summary(phase1_result: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Per key, segments that reported a change and distinct candidate dates."""
    ok = phase1_result.filter(F.col("status") == "ok")
    return ok.groupBy(*key_cols).agg(
        F.countDistinct(SEGMENT).alias("n_segments"), F.countDistinct("change_point").alias("n_candidates"))


LAST = "DATE'9999-12-31'"  # stands for the end of the interval after the last candidate


def intervals(hist: DataFrame, cands: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The histogram with the dates up to and including each candidate folded into the candidate's row."""
    keys = list(key_cols)
    dates = hist.select(*keys, "fecha").distinct().join(cands.withColumn("is_cand", F.lit(True)), keys + ["fecha"], "left")
    ahead = Window.partitionBy(*keys).orderBy("fecha").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ends = dates.select(*keys, "fecha", F.coalesce(
        F.first(F.when(F.col("is_cand"), F.col("fecha")), ignorenulls=True).over(ahead), F.expr(LAST)).alias("ends"))
    return (hist.join(ends, keys + ["fecha"]).groupBy(*keys, "n", "k", "ends", "j").agg(F.sum("cnt").alias("cnt"))
            .withColumnRenamed("ends", "fecha"))


def whole_histogram(vcs: DataFrame, key_cols: Sequence[str], reuse: str = "table", known_rows: int | None = None,
                    rank_strategy: str = "auto") -> DataFrame:
    """T6 for phase 2: the histogram of whole series from the folded points of their segments."""
    keys = list(key_cols)
    vc = vcs.groupBy(*keys, "fecha", "value").agg(F.sum("c").alias("c"))
    return folded_histogram(vc, known_rows, keys, reuse, rank_strategy)[0]


def phase2(vcs: DataFrame, cands: DataFrame, series: DataFrame, key_cols: Sequence[str],
           min_points: int = MIN_POINTS, max_seconds: float | None = None, reuse: str = "table",
           known_rows: int | None = None, rank_strategy: str = "auto", late: DataFrame | None = None,
           hist: DataFrame | None = None) -> DataFrame:
    """ED-PELT per key with changes restricted to candidate dates; keys in `late` give a time-out.

    `hist`: the `whole_histogram` of `vcs`, if it is there already.
    """
    keys = list(key_cols)
    if hist is None:
        hist = whole_histogram(vcs, keys, reuse, known_rows, rank_strategy)
    return run_dp(intervals(hist, cands, keys), keys, result_schema(series, keys), min_points, max_seconds, timed_out=late)


def divide_pelt(series: DataFrame, key_cols: Sequence[str], segments: int = DIVIDE_SEGMENTS,
                sale_col: str = "clave_venta", min_points: int = MIN_POINTS, max_seconds: float | None = None,
                reuse: str = "table", with_phase1: bool = False, rank_strategy: str = "auto"):
    """(key..., change_point, status) of the divide-and-merge detector.

    With `with_phase1=True` returns (result, phase-1 result).
    """
    keys = list(key_cols)
    vcs, rows = materialize(segment_counts(series, keys, segments, sale_col), reuse, count=True)
    p1, hist = side_by_side(
        lambda: materialize(phase1(vcs, series, keys, min_points, max_seconds, reuse, rows, rank_strategy), reuse),
        lambda: materialize(whole_histogram(vcs, keys, reuse, rows, rank_strategy), reuse))
    result = phase2(vcs, candidates(p1, keys), series, keys, min_points, max_seconds, reuse, rows, rank_strategy,
                    timed_out(p1, keys), hist)
    return (result, p1) if with_phase1 else result
