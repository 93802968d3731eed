"""ED-PELT change points: Spark aggregates for the counts, a small DP per key.

Semantics (n = number of points of a series, sorted by date):
  * n <= 2 gives nothing; every segment holds at least `min_points` points;
  * penalty = 3 ln n; k = min(n, ceil(4 ln n)) quantiles;
  * threshold t_i = sorted[floor((n-1) p_i)], p_i = 1 / (1 + (2n-1)^-z_i),
    z_i = -1 + (2i+1)/k;
  * P_i(tau) = sum over the first tau points of 2*[v < t_i] + [v == t_i];
  * cost(a, b) = (2 (-ln(2n-1)) / k) * sum_i L (f ln f + (1-f) ln(1-f)),
    L = b - a, f = (P_i(b) - P_i(a)) / 2L, terms with f in {0, 1} skipped;
  * best(0) = -penalty, best(b) = min_a best(a) + cost(a, b) + penalty, first
    minimum wins; a change may only fall between two different dates;
  * each change is reported as the last date of the segment on its left.

Spark formulation.  A change can only sit on a date boundary and the cost only
needs P_i at boundaries, so the DP never needs raw rows:
  1. (key, fecha, value) -> count: map-side combined, so a hot key is
     reduced before its shuffle;
  2. positions: the rank window over a key's distinct values also tells how
     many of the k target ranks lie below a value, so its positions
     a = #{t <= v} and b = #{t < v} among the thresholds need no threshold;
  3. the folded points take their positions by a join on (key, value), which
     spreads a hot key over its values; P_i of a date = #{a <= i} + #{b <= i},
     so a histogram over (key, fecha, position) carries everything;
  4. `mapInPandas` over the histogram hash-partitioned by key and sorted:
     each key's at most dates x (k+1) rows feed an exact DP over date
     boundaries in numpy (cumulative sums, then the recurrence).
While no key has more than `COLOCATED_MAX_ROWS` folded points, steps 2 to 4 share
one exchange on the key (`colocated_histogram`) instead of spreading keys over
their values.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import MIN_POINTS
from ..session import materialize

RESULT_FIELDS = [T.StructField("change_point", T.DateType()), T.StructField("status", T.StringType())]


def value_counts(series: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """(key..., fecha, value, c): the series with repeated points folded."""
    return series.groupBy(*key_cols, "fecha", "value").agg(F.count(F.lit(1)).alias("c"))


# A key whose distinct values fit in one task is ranked with one window per
# key; above this the ranks come from a range-partitioned sort.
WINDOW_RANK_MAX_VALUES = 5_000_000


def _ranks_window(vals: DataFrame, keys: list[str]):
    """Ranks with one window per key: (ranked with lo and n, None)."""
    w = Window.partitionBy(*keys).orderBy("value")
    return vals.select(
        *keys, "value", "cv", F.lit(0).alias("part"),
        F.coalesce(F.sum("cv").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lo"),
        F.sum("cv").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    ), None


def _ranks_range(vals: DataFrame, keys: list[str], partitions: int, reuse: str):
    """Ranks from a range-partitioned sort: every window holds one range partition.

    The sort is materialized so its sampled bounds are fixed; a key spanning
    several partitions gets per-partition offsets from a small window over
    (key, partition) counts.  Returns (ranked with lo and n, offsets).
    """
    if reuse == "none":
        raise ValueError("range ranks need a written sort: each reading would sample other bounds")
    parted = materialize(vals.repartitionByRange(partitions, *keys, "value")
                         .withColumn("part", F.spark_partition_id()), reuse)
    local = Window.partitionBy(*keys, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    counts = parted.groupBy(*keys, "part").agg(F.sum("cv").alias("pc"))
    by_part = Window.partitionBy(*keys).orderBy("part")
    offsets = counts.select(
        *keys, "part",
        F.coalesce(F.sum("pc").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
        F.sum("pc").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    ranked = parted.select(*keys, "value", "part", "cv",
                           F.coalesce(F.sum("cv").over(local), F.lit(0)).alias("lo_local"))
    ranked = ranked.join(offsets, keys + ["part"]).select(
        *keys, "value", "cv", "part", (F.col("off") + F.col("lo_local")).alias("lo"), "n")
    return ranked, offsets


def _ranks(vc: DataFrame, keys: list[str], strategy: str, partitions: int | None, reuse: str,
           window_max_values: int, known_rows: int | None):
    """(distinct values with lo = points below, cv = points at, n = points of the key; offsets or None; the values)."""
    vals = vc.groupBy(*keys, "value").agg(F.sum("c").alias("cv"))
    if strategy == "auto" and known_rows is not None and known_rows <= window_max_values:
        strategy = "window"
    if strategy == "auto":
        widest = vals.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        strategy = "window" if widest <= window_max_values else "range"
    if strategy == "window":
        return *_ranks_window(vals, keys), vals
    if strategy == "range":
        parts = partitions or int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return *_ranks_range(vals, keys, parts, reuse), vals
    raise ValueError(f"unknown rank strategy {strategy!r}")


def _k(n):
    return F.least(n, F.ceil(F.lit(4.0) * F.log(n))).cast("int")


def _target(n, k, i):
    """Rank of quantile i: floor((n - 1) p_i)."""
    z = F.lit(-1.0) + (i * 2 + F.lit(1.0)) / k
    return F.floor((n - 1) * (F.lit(1.0) / (F.lit(1.0) + F.pow(n * 2 - 1, -z))))


def _sortable(value):
    """A double as a long of the same order (zero has one form)."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _positions_radix(vc: DataFrame, keys: list[str], reuse: str) -> DataFrame:
    """Positions by histogram refinement: no rank of every value, no sort of a key's values.

    Values are longs of the same order, taken 16 bits at a time.  Counts by the first 16 and the first 32 bits tell
    how many points, so how many target ranks, lie below each such range.  Only the ranges that hold a target are
    refined, by 48 and then all 64 bits, which gives the thresholds; a value's position is what lies below its 32-bit
    range and the thresholds inside it.  A window holds the at most 65,536 ranges of one coarser range.
    """
    vals = materialize(vc.groupBy(*keys, "value").agg(F.sum("c").alias("cv")).withColumn("u", _sortable(F.col("value")))
                       .withColumn("p1", F.shiftright("u", 32)), reuse)

    def counted(df, within, by, lo, targets):
        """(.., lo = points below the range) over the ranges `by` of each `within`, and the targets inside."""
        w = Window.partitionBy(*keys, *within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumn("lo", F.coalesce(F.sum("cv").over(w), F.lit(0)) + lo)
        return df.withColumn("inside", F.filter(targets, lambda t: (t >= F.col("lo")) & (t < F.col("lo") + F.col("cv"))))

    fine = materialize(vals.groupBy(*keys, "p1").agg(F.sum("cv").alias("cv")).withColumn("p0", F.shiftright("p1", 16)), reuse)
    coarse = fine.groupBy(*keys, "p0").agg(F.sum("cv").alias("cv"))
    whole = Window.partitionBy(*keys)
    n, k = F.col("n"), F.col("k")
    coarse = coarse.withColumn("n", F.sum("cv").over(whole)).filter(n > 2).withColumn("k", _k(n))
    coarse = counted(coarse, [], "p0", F.lit(0), F.array().cast("array<bigint>")).select(*keys, "p0", "n", "k", F.col("lo").alias("lo0"))
    fine = fine.join(coarse, [*keys, "p0"]).withColumn(
        "targets", F.transform(F.sequence(F.lit(0), k - 1), lambda i: _target(n, k, i)))
    fine = counted(fine, ["p0"], "p1", F.col("lo0"), F.col("targets"))
    fine = materialize(fine.select(*keys, "p1", "n", "k", "lo", "inside", F.size(F.filter(
        "targets", lambda t: t < F.col("lo"))).alias("base")), reuse)
    held = fine.where(F.size("inside") > 0).select(*keys, "p1", F.col("lo").alias("lo1"), F.col("inside").alias("inside1"))
    mid = vals.groupBy(*keys, "p1", F.shiftright("u", 16).alias("p2")).agg(F.sum("cv").alias("cv")).join(held, [*keys, "p1"])
    mid = counted(mid, ["p1"], "p2", F.col("lo1"), F.col("inside1")).where(F.size("inside") > 0).select(
        *keys, "p1", "p2", F.col("lo").alias("lo2"), F.col("inside").alias("inside2"))
    last = vals.withColumn("p2", F.shiftright("u", 16)).join(mid, [*keys, "p1", "p2"])
    last = counted(last, ["p1", "p2"], "u", F.col("lo2"), F.col("inside2")).where(F.size("inside") > 0)
    ts = last.groupBy(*keys, "p1").agg(F.collect_list(F.struct("u", F.size("inside").alias("m"))).alias("ts"))  # k at most
    found = (vals.join(fine.select(*keys, "p1", "n", "k", "base"), [*keys, "p1"]).join(ts, [*keys, "p1"], "left"))
    held = F.coalesce("ts", F.array().cast("array<struct<u:bigint,m:int>>"))
    below = lambda test: F.col("base") + F.aggregate(F.filter(held, test), F.lit(0), lambda acc, t: acc + t["m"])
    return found.select(*keys, "value", "n", "k", below(lambda t: t["u"] <= F.col("u")).alias("a"),
                        below(lambda t: t["u"] < F.col("u")).alias("b"))


def positions(vc: DataFrame, key_cols: Sequence[str], strategy: str = "auto", partitions: int | None = None,
              reuse: str = "table", window_max_values: int = WINDOW_RANK_MAX_VALUES,
              known_rows: int | None = None) -> DataFrame:
    """(key..., value, n, k, a, b): positions of each distinct value among its key's thresholds, keys with n > 2.

    A threshold is the value at a target rank, so a = #{t <= v} counts the
    targets below lo + cv and b = #{t < v} those below lo.  See `thresholds`
    for the strategies; "radix" finds the same positions by histogram refinement,
    without ranking a key's values.
    """
    keys = list(key_cols)
    if strategy == "radix":
        return _positions_radix(vc, keys, reuse)
    ranked, _, _ = _ranks(vc, keys, strategy, partitions, reuse, window_max_values, known_rows)
    n, k = F.col("n"), F.col("k")
    ranked = ranked.filter(n > 2).withColumn("k", _k(n)).withColumn(
        "targets", F.transform(F.sequence(F.lit(0), k - 1), lambda i: _target(n, k, i)))
    below = lambda x: F.size(F.filter("targets", lambda t: t < x))
    return ranked.select(*keys, "value", "n", "k", below(F.col("lo") + F.col("cv")).alias("a"), below(F.col("lo")).alias("b"))


def thresholds(vc: DataFrame, key_cols: Sequence[str], strategy: str = "auto",
               partitions: int | None = None, reuse: str = "table",
               window_max_values: int = WINDOW_RANK_MAX_VALUES, known_rows: int | None = None) -> DataFrame:
    """Per key with n > 2, n, k and the sorted threshold array `ts` (k doubles).

    strategy: "window" (one window per key over its distinct values), "range"
    (range-partitioned ranks, no window larger than a partition) or "auto"
    (window unless the widest key has more than `window_max_values` distinct
    values, checked with one aggregate).  `known_rows`, the row count of `vc`
    when known, bounds every key's distinct values and can spare the check.
    """
    keys = list(key_cols)
    ranked, offsets, vals = _ranks(vc, keys, strategy, partitions, reuse, window_max_values, known_rows)
    totals = vals.groupBy(*keys).agg(F.sum("cv").alias("n"))
    n, k = F.col("n"), F.col("k")
    nk = totals.filter(n > 2).select(*keys, "n", _k(n).alias("k"))
    targets = nk.select(*keys, "n", "k", F.explode(F.sequence(F.lit(0), k - 1)).alias("i")).select(
        *keys, "n", "k", "i", _target(n, k, F.col("i")).alias("pos"))
    if offsets is None:
        targets = targets.withColumn("part", F.lit(0))
    else:
        # route each target rank to the range partition holding it (as-of over offsets)
        marks = offsets.select(*keys, F.col("off").alias("pos"), F.lit(0).alias("kind"), "part")
        asks = targets.select(*keys, "pos", F.lit(1).alias("kind"), "n", "k", "i")
        wo = Window.partitionBy(*keys).orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
        targets = marks.unionByName(asks, allowMissingColumns=True).withColumn(
            "part", F.last("part", ignorenulls=True).over(wo)).filter(F.col("kind") == 1).drop("kind")
    lookup = ranked.select(*keys, "part", F.col("lo").alias("pos"), F.lit(0).alias("kind"), "value")
    asks = targets.select(*keys, "part", "pos", F.lit(1).alias("kind"), "n", "k", "i")
    u = lookup.unionByName(asks, allowMissingColumns=True)
    wl = Window.partitionBy(*keys, "part").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    picked = u.withColumn("t", F.last("value", ignorenulls=True).over(wl)).filter(F.col("kind") == 1)
    return picked.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("k").alias("k"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda e: e["t"]).alias("ts"),
    )


def threshold_histogram(vc: DataFrame, pos: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """(key..., n, k, fecha, j, cnt); P_i of a date = sum of cnt over j <= i.

    The folded points meet their value's positions by a join on (key, value).
    """
    keys = list(key_cols)
    at = vc.join(pos, keys + ["value"]).select(*keys, "n", "k", "fecha", F.explode(F.array("a", "b")).alias("j"), "c")
    return at.groupBy(*keys, "n", "k", "fecha", "j").agg(F.sum("c").alias("cnt"))


# Folded points of the widest key up to which all steps share one exchange on the
# key; they pass its task's windows in a spilling buffer.
COLOCATED_MAX_ROWS = 5_000_000


def colocated_histogram(vc: DataFrame, key_cols: Sequence[str], place: Sequence[str] | None = None,
                        partitions: int | None = None) -> DataFrame:
    """`threshold_histogram` with one exchange, on `place` (default: the key; any part of it).

    The rank of a folded point comes from a window in value order over its key's folded points, so there is no
    distinct, no join and no second shuffle; the rows stay placed by key for the dynamic program.
    """
    keys = list(key_cols)
    placed = vc.where(" and ".join(f"`{c}` is not null" for c in keys) or "true")
    placed = placed.repartition(partitions or int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions")), *(place or keys))
    up_to = Window.partitionBy(*keys).orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    n, k = F.col("n"), F.col("k")
    ranked = placed.select(*keys, "fecha", "c", F.sum("c").over(up_to).alias("hi"),
                           F.sum("c").over(Window.partitionBy(*keys, "value")).alias("cv"),
                           F.sum("c").over(Window.partitionBy(*keys)).alias("n"))
    ranked = ranked.where(n > 2).withColumn("k", _k(n)).withColumn(
        "targets", F.transform(F.sequence(F.lit(0), k - 1), lambda i: _target(n, k, i)))
    below = lambda x: F.size(F.filter("targets", lambda t: t < x))
    at = ranked.select(*keys, "n", "k", "fecha", "c", F.explode(F.array(
        below(F.col("hi")), below(F.col("hi") - F.col("cv")))).alias("j"))
    return at.groupBy(*keys, "n", "k", "fecha", "j").agg(F.sum("c").alias("cnt"))


def fits_colocated(vc: DataFrame, key_cols: Sequence[str], known_rows: int | None,
                   most: int | None = None) -> bool:
    """Whether no key has more than `most` folded points; `known_rows`, all of them, can spare the check."""
    most = COLOCATED_MAX_ROWS if most is None else most
    if known_rows is not None and known_rows <= most:
        return True
    return (vc.groupBy(*key_cols).count().agg(F.max("count")).first()[0] or 0) <= most


def partial_sums(hist: DataFrame, th: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """(key..., fecha, i, threshold, partial_sum); P_i at the boundary after each date."""
    keys = list(key_cols)
    daily = hist.groupBy(*keys, "k", "fecha").agg(F.collect_list(F.struct("j", "cnt")).alias("hs"))
    per_i = daily.select(*keys, "fecha", "hs", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    per_i = per_i.select(*keys, "fecha", "i", F.aggregate(
        F.filter("hs", lambda h: h["j"] <= F.col("i")), F.lit(0).cast("long"),
        lambda acc, h: acc + h["cnt"]).alias("p"))
    w = Window.partitionBy(*keys, "i").orderBy("fecha").rowsBetween(Window.unboundedPreceding, 0)
    out = per_i.withColumn("partial_sum", F.sum("p").over(w))
    tsx = th.select(*keys, F.posexplode("ts").alias("i", "threshold"))
    return out.join(tsx, keys + ["i"]).select(*keys, "fecha", F.col("i").cast("long").alias("i"), "threshold",
                                              "partial_sum")


# --- per-key dynamic program (runs inside mapInPandas) ---------------------

def segment_costs(P: np.ndarray, tau: np.ndarray, a_idx: np.ndarray, b: int, factor: float) -> np.ndarray:
    """cost(a, b) for every a in a_idx; terms summed in index order."""
    L = (tau[b] - tau[a_idx]).astype(np.float64)
    S = P[b][None, :] - P[a_idx]
    fit = S * 0.5 / L[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        term = L[:, None] * (fit * np.log(fit) + (1 - fit) * np.log(1 - fit))
    term[(S == 0) | (S == (2 * (tau[b] - tau[a_idx]))[:, None])] = 0.0
    return factor * np.cumsum(term, axis=1)[:, -1]


PAIR_TABLE_LIMIT = 2_000_000  # (B+1)^2 * k cells: cost of every pair at once below this


def pair_costs(P: np.ndarray, tau: np.ndarray, factor: float) -> np.ndarray:
    """cost(a, b) for every pair of boundaries (garbage where b <= a; masked by the caller)."""
    Li = tau[None, :] - tau[:, None]
    L = Li.astype(np.float64)[:, :, None]
    S = P[None, :, :] - P[:, None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        fit = S * 0.5 / L
        term = L * (fit * np.log(fit) + (1 - fit) * np.log(1 - fit))
    term[(S == 0) | (S == 2 * Li[:, :, None])] = 0.0
    return factor * np.cumsum(term, axis=2)[:, :, -1]


def evaluations(tau: np.ndarray, ok: np.ndarray, min_points: int = MIN_POINTS) -> np.ndarray:
    """Costs that the recurrence may need at each boundary: its starts at `min_points` points or more before it.

    A start is boundary 0 or a legal boundary that itself has `min_points` points before it.  What pruning
    saves is not taken off, so the number depends on the dates alone and is the same on any host.
    """
    start = ok & ((np.arange(len(tau)) == 0) | (tau >= min_points))
    before = np.concatenate([[0], np.cumsum(start)])[np.searchsorted(tau, tau - min_points, side="right")]
    out = np.where(ok | (np.arange(len(tau)) == len(tau) - 1), before, 0)
    out[0] = 0
    return out


def _legal(B: int, allowed: np.ndarray | None) -> np.ndarray:
    ok = np.ones(B + 1, dtype=bool) if allowed is None else np.asarray(allowed, dtype=bool).copy()
    ok[0] = True
    return ok


def search(P: np.ndarray, tau: np.ndarray, k: int, min_points: int, ok: np.ndarray, last: int,
           max_seconds: float | None = None):
    """best(b) and the start that gives it for the boundaries up to `last`; None on time-out."""
    B = len(tau) - 1
    n = int(tau[-1])
    penalty = 3 * math.log(n)
    factor = 2.0 * -math.log(2 * n - 1) / k
    best = np.full(B + 1, np.inf)
    prev = np.full(B + 1, -1, dtype=np.int64)
    best[0] = -penalty
    table = pair_costs(P, tau, factor) if (B + 1) ** 2 * k <= PAIR_TABLE_LIMIT else None
    # Pruning (only without the pair table): a start a dominated at a legal
    # boundary b, best(a) + cost(a, b) > best(b) + margin, can never beat b at
    # any boundary >= min_points points after b (the cost is superadditive), so
    # from there on it is skipped.  The strict margin keeps first-minimum ties.
    dead_from = np.full(B + 1, np.iinfo(np.int64).max, dtype=np.int64)
    start = time.monotonic()
    for b in range(1, last + 1):
        if max_seconds is not None and time.monotonic() - start >= max_seconds:
            return None
        if tau[b] < min_points or not (ok[b] or b == B):
            continue  # best(b) of a boundary that may not hold a change is never used
        cand = (tau[b] - tau[:b] >= min_points) & ok[:b] & np.isfinite(best[:b]) & (tau[b] < dead_from[:b])
        a_idx = np.nonzero(cand)[0]
        if a_idx.size == 0:
            continue
        costs = table[a_idx, b] if table is not None else segment_costs(P, tau, a_idx, b, factor)
        totals = (best[a_idx] + costs) + penalty
        if tau[b] < 2 * min_points:
            totals = np.where(a_idx == 0, costs, totals)
        m = int(np.argmin(totals))
        best[b], prev[b] = totals[m], a_idx[m]
        if table is None and ok[b] and b < B:
            margin = 1e-9 * (abs(best[b]) + penalty + 1.0)
            beaten = a_idx[totals > best[b] + penalty + margin]
            dead_from[beaten] = np.minimum(dead_from[beaten], tau[b] + min_points)
    return best, prev


def _trace(prev: np.ndarray, cur: int) -> list[int]:
    out = []
    while cur > 0:
        out.append(int(cur))
        cur = prev[cur]
    return out[::-1]


def solve(P: np.ndarray, tau: np.ndarray, k: int, min_points: int = MIN_POINTS,
          allowed: np.ndarray | None = None, max_seconds: float | None = None):
    """Exact DP over boundaries 0..B; boundary indexes of the changes, or None on time-out.

    `allowed[b]` (b in 1..B-1) says whether a change may sit on boundary b.
    """
    B = len(tau) - 1
    found = search(P, tau, k, min_points, _legal(B, allowed), B, max_seconds)
    return None if found is None else _trace(found[1], found[1][B])


def solve_within(P: np.ndarray, tau: np.ndarray, k: int, max_evaluations: int, min_points: int = MIN_POINTS,
                 allowed: np.ndarray | None = None):
    """T13 by work instead of time: (changes, evaluations, complete, cost, lower bound).

    The search ends before the first boundary whose evaluations would pass `max_evaluations`; c is the one before
    it.  The result is then the best of the known optima up to a start s <= c with one segment from s to the end.
    No segmentation costs less than the lower bound: its segment over c starts at some s <= c, what lies before s
    costs best(s) at least, the segment at least its part up to c (the cost is superadditive), and what lies behind
    c at least the cost of all dates apart.  A complete search has a lower bound equal to its cost.
    """
    B = len(tau) - 1
    ok = _legal(B, allowed)
    used = np.cumsum(evaluations(tau, ok, min_points))
    last = int(np.searchsorted(used, max_evaluations, side="right")) - 1
    best, prev = search(P, tau, k, min_points, ok, last)
    if last >= B:
        whole = float(best[B]) if np.isfinite(best[B]) else None  # fewer points than one segment: no cost
        return _trace(prev, prev[B]), int(used[B]), True, whole, whole
    n = int(tau[-1])
    penalty, factor = 3 * math.log(n), 2.0 * -math.log(2 * n - 1) / k
    starts = np.flatnonzero(ok[:last + 1] & np.isfinite(best[:last + 1]))
    ends = starts[tau[B] - tau[starts] >= min_points]
    costs = segment_costs(P, tau, ends, B, factor)
    totals = np.where((ends == 0) & (tau[B] < 2 * min_points), costs, (best[ends] + costs) + penalty)
    m = int(np.argmin(totals))
    behind = starts[starts < last]
    low = [best[s] + penalty for s in starts[starts == last]]
    if len(behind):
        low.append(((best[behind] + segment_costs(P, tau, behind, last, factor)) + penalty).min())
    apart = sum(float(segment_costs(P, tau, np.array([b - 1]), b, factor)[0]) for b in range(last + 1, B + 1))
    upper = float(totals[m])
    return _trace(prev, int(ends[m])), int(used[last]), False, upper, min(upper, float(min(low)) + apart)


EPOCH = "DATE'1970-01-01'"


def boundary_sums(d, j, cnt, k):
    """(days, P, tau) from one key's histogram rows (int day, position, count): sums up to the end of each date."""
    uniq, inv = np.unique(d, return_inverse=True)
    B = len(uniq)
    H = np.bincount(inv * (k + 1) + j, weights=cnt, minlength=B * (k + 1)).astype(np.int64).reshape(B, k + 1)
    P = np.vstack([np.zeros((1, k), dtype=np.int64), np.cumsum(np.cumsum(H, axis=1)[:, :k], axis=0)])
    return uniq, P, np.concatenate([[0], np.cumsum(H.sum(axis=1) // 2)])


def _changes(min_points, max_seconds):
    """One key's (day, status) rows; a row at position -1 marks a timed-out key."""

    def answer(d, j, cnt, k):
        if (j < 0).any():
            return [(None, "timeout")]
        days, P, tau = boundary_sums(d, j, cnt, k)
        found = solve(P, tau, k, min_points, None, max_seconds)
        return [(None, "timeout")] if found is None else [(int(days[b - 1]), "ok") for b in found]

    return answer, {"cp": "Int32", "status": "object"}


def _within(min_points, max_evaluations):
    """One key's row (points, dates, evaluations, status, cost, lower bound, days of the changes)."""

    def answer(d, j, cnt, k):
        days, P, tau = boundary_sums(d, j, cnt, k)
        found, used, complete, cost, low = solve_within(P, tau, k, max_evaluations, min_points)
        return [(int(tau[-1]), len(days), used, "ok" if complete else "cut", cost, low, [int(days[b - 1]) for b in found])]

    return answer, {"points": "int64", "dates": "int32", "evaluations": "int64", "status": "object", "cost": "float64",
                    "lower_bound": "float64", "cps": "object"}


def _key_starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Row indexes where a new key begins (rows are sorted by key)."""
    change = np.zeros(len(pdf), dtype=bool)
    change[0] = True
    for c in keys:
        col = pdf[c]
        prev = col.shift()
        diff = (col != prev).to_numpy()
        both_null = (col.isna() & prev.isna()).to_numpy()
        change |= diff & ~both_null
    return np.flatnonzero(change)


def _dp_batches(key_cols: Sequence[str], answer, dtypes: dict[str, str]):
    """Walks sorted batches key by key; `answer(d, j, cnt, k)` gives a key's rows, columns as in `dtypes`."""
    keys = list(key_cols)

    def process(pdf: pd.DataFrame) -> pd.DataFrame:
        starts = _key_starts(pdf, keys)
        bounds = np.append(starts, len(pdf))
        d = pdf["d"].to_numpy(np.int64)
        j = pdf["j"].to_numpy(np.int64)
        cnt = pdf["cnt"].to_numpy(np.float64)
        kk = pdf["k"].fillna(-1).to_numpy(np.int64)
        rows, found = [], []
        for g in range(len(starts)):
            lo, hi = bounds[g], bounds[g + 1]
            k = int(kk[lo:hi].max())
            if k <= 0:
                continue
            some = answer(d[lo:hi], j[lo:hi], cnt[lo:hi], k)
            rows.extend([lo] * len(some))
            found.extend(some)
        out = pdf.iloc[rows][keys].reset_index(drop=True)
        for c, (name, dtype) in enumerate(dtypes.items()):
            out[name] = pd.Series([f[c] for f in found], dtype=dtype)
        return out

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if len(pdf) == 0:
                continue
            last = _key_starts(pdf, keys)[-1]
            carry = pdf.iloc[last:].reset_index(drop=True)
            if last > 0:
                yield process(pdf.iloc[:last].reset_index(drop=True))
        if carry is not None and len(carry):
            yield process(carry)

    return run


def result_schema(series: DataFrame, key_cols: Sequence[str]) -> T.StructType:
    return T.StructType([series.schema[c] for c in key_cols] + RESULT_FIELDS)


def run_dp(hist: DataFrame, key_cols: Sequence[str], schema: T.StructType, min_points: int = MIN_POINTS,
           max_seconds: float | None = None, partitions: int | None = None,
           timed_out: DataFrame | None = None, placed: bool = False) -> DataFrame:
    """Per-key DP over the histogram rows: (key..., change_point, status).

    `placed`: the rows lie by key already (`colocated_histogram`).

    `timed_out` (key...): keys that get status 'timeout' whatever their rows say;
    they travel with the histogram as markers (no join).
    """
    keys = list(key_cols)
    if timed_out is not None:
        hist = hist.select(*keys, "k", "fecha", "j", "cnt").unionByName(timed_out.select(
            *keys, F.lit(1).cast(hist.schema["k"].dataType).alias("k"), F.expr(EPOCH).alias("fecha"),
            F.lit(-1).cast(hist.schema["j"].dataType).alias("j"), F.lit(0).cast(hist.schema["cnt"].dataType).alias("cnt")))
    out = _per_key(hist, keys, schema, "cp int, status string", *_changes(min_points, max_seconds), partitions=partitions,
                   placed=placed and timed_out is None)
    return out.select(*keys, F.date_add(F.expr(EPOCH), F.col("cp")).alias("change_point"), "status")


def _per_key(hist: DataFrame, keys: list[str], schema: T.StructType, added: str, answer, dtypes: dict[str, str],
             partitions: int | None = None, placed: bool = False) -> DataFrame:
    """(key..., `added`): what `answer` says of each key's histogram rows.

    Rows are hash-partitioned by key into `partitions` (default: the session's
    shuffle partitions) and sorted by key; `mapInPandas` then walks each Arrow
    batch key by key (a key cut by a batch edge is carried to the next batch),
    so the Python side pays per batch, not per key, and holds one batch plus
    one key at a time.  The number is fixed because AQE would merge the small
    rows of this stage, which costs CPU rather than bytes, into few tasks.
    """
    parts = partitions or int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = hist.select(*keys, F.col("k").cast("int").alias("k"), F.datediff("fecha", F.expr(EPOCH)).alias("d"),
                       F.col("j").cast("long").alias("j"), F.col("cnt").cast("long").alias("cnt"))
    if not placed:  # by a hash of the key: by the key itself Spark leaves the shuffle out where both sides of a union
        data = data.repartition(parts, F.xxhash64(*keys))  # lie by key, and AQE may then part a key's rows
    data = data.sortWithinPartitions(*keys, "d")
    key_fields = [f for f in schema.fields if f.name in keys]
    mid = T.StructType(key_fields + T.StructType.fromDDL(added).fields)
    return data.mapInPandas(_dp_batches(keys, answer, dtypes), mid)


def folded_histogram(vc: DataFrame, rows: int | None, key_cols: Sequence[str], reuse: str, rank_strategy: str,
                     place: Sequence[str] | None = None) -> tuple[DataFrame, bool]:
    """(histogram of folded points, whether it lies by key): one exchange if the widest key fits, else spread."""
    keys = list(key_cols)
    if rank_strategy == "auto" and fits_colocated(vc, keys, rows):
        return colocated_histogram(vc, keys, place), True
    # written: the join then knows its size, and the DP's shuffle is not merged with the rank window's
    pos = materialize(positions(vc, keys, rank_strategy, reuse=reuse, known_rows=rows), reuse)
    return threshold_histogram(vc, pos, keys), False


def _folded(series: DataFrame, keys: list[str], reuse: str, rank_strategy: str) -> tuple[DataFrame, bool]:
    """`folded_histogram` of a series, over written folded points."""
    vc, rows = materialize(value_counts(series, keys), reuse, count=True)
    return folded_histogram(vc, rows, keys, reuse, rank_strategy)


def edpelt_within(series: DataFrame, key_cols: Sequence[str], max_evaluations: int, min_points: int = MIN_POINTS,
                  reuse: str = "table", rank_strategy: str = "auto") -> DataFrame:
    """T5 under a work budget per series, one row per series of more than two points.

    (key..., points, dates, evaluations, status, cost, lower_bound, change_points): status 'ok' with the optimum, or
    'cut' with the best segmentation known when the next boundary would have passed `max_evaluations` cost
    evaluations; the optimum costs between `lower_bound` and `cost`.  The budget counts work, so the rows are the
    same on any host and at any load.
    """
    keys = list(key_cols)
    hist, placed = _folded(series, keys, reuse, rank_strategy)
    out = _per_key(hist, keys, result_schema(series, keys),
                   "points bigint, dates int, evaluations bigint, status string, cost double, lower_bound double, cps array<int>",
                   *_within(min_points, max_evaluations), placed=placed)
    return out.select(*keys, "points", "dates", "evaluations", "status", "cost", "lower_bound", F.transform(
        "cps", lambda c: F.date_add(F.expr(EPOCH), c)).alias("change_points"))


def edpelt(series: DataFrame, key_cols: Sequence[str], min_points: int = MIN_POINTS, max_seconds: float | None = None,
           reuse: str = "table", rank_strategy: str = "auto", max_evaluations: int | None = None) -> DataFrame:
    """T5 + T12: ED-PELT per key, (key..., change_point date, status); no row for a series without change.

    The folded points are written (`reuse`, see `session.materialize`), so the
    fact table is scanned once and their number is known.  `rank_strategy`: "auto"
    (one exchange on the key while the widest key fits, else as `positions`), or
    one of `positions`' strategies.
    `max_seconds` (default: none) is a budget per series; a series that
    reaches it gives one row with status 'timeout'.  `max_evaluations` is a budget
    of work (see `edpelt_within`); a series that reaches it gives the changes known
    by then with status 'cut', or one row without a date.
    """
    keys = list(key_cols)
    if max_evaluations is not None:
        if max_seconds is not None:
            raise ValueError("give max_seconds or max_evaluations, not both")
        rows = edpelt_within(series, keys, max_evaluations, min_points, reuse, rank_strategy)
        changes = F.when((F.size("change_points") == 0) & (F.col("status") == "cut"),
                         F.array(F.lit(None).cast("date"))).otherwise(F.col("change_points"))
        return rows.select(*keys, F.explode(changes).alias("change_point"), "status")
    hist, placed = _folded(series, keys, reuse, rank_strategy)
    return run_dp(hist, keys, result_schema(series, keys), min_points, max_seconds, placed=placed)
