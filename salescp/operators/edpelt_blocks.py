"""ED-PELT for series of very many dates: the dynamic program by blocks of dates.

A series is cut in blocks of `block_days` calendar days; a block holds its dates' sums and
for each date the best cost found so far and the start that gives it.  Stage j:

  close   block j, which has met every earlier block, runs the recurrence inside;
  relax   every later block meets block j, each pair in a task of its own: best(b) becomes
          the least over the starts of block j that are still alive.

Blocks meet in ascending order and a later start only wins with a strictly lower total, so the
first minimum wins as in `edpelt.solve`, and costs are added in the same order: the result is
the same.  A start that a boundary of its own block beats is not handed on (the pruning of
`search`).  The states between stages are written tables.

Scale.  As many stages as the longest series has blocks; a task holds two blocks of at most
`block_days` x (k + 1) numbers, never a series.  The sums at a block's begin come from the sums
of whole blocks, a window of one row per block.  The way back along the chosen starts streams a
series' blocks from the last to the first and holds one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import MIN_POINTS
from ..session import materialize
from .edpelt import EPOCH, _folded, _key_starts, boundary_sums, result_schema, segment_costs

ORIGIN = -(1 << 31)  # stands for the day of boundary 0
NEVER = np.iinfo(np.int64).max
STATE = ("n bigint, k int, idx int, blocks int, days binary, tau binary, sums binary, best binary, prev binary, dead binary")


class Block:
    """The boundaries of one block: day, points before (tau), P, best cost, the start's day, and from where it is beaten."""

    def __init__(self, n, k, days, tau, sums, best, prev, dead):
        self.n, self.k, self.days, self.tau, self.sums, self.best, self.prev, self.dead = n, k, days, tau, sums, best, prev, dead
        self.penalty, self.factor = 3 * math.log(n), 2.0 * -math.log(2 * n - 1) / k

    @classmethod
    def read(cls, row, suffix="") -> "Block":
        n, k = int(getattr(row, "n")), int(getattr(row, "k"))
        part = {c: np.frombuffer(getattr(row, c + suffix), dtype=t) for c, t in (
            ("days", "<i8"), ("tau", "<i8"), ("sums", "<i8"), ("best", "<f8"), ("prev", "<i8"), ("dead", "<i8"))}
        return cls(n, k, part["days"], part["tau"], part["sums"].reshape(-1, k), part["best"].copy(), part["prev"].copy(),
                   part["dead"].copy())

    def written(self) -> dict:
        return {c: np.ascontiguousarray(getattr(self, c)).tobytes() for c in ("days", "tau", "sums", "best", "prev", "dead")}

    def meet(self, starts: "Block", b: int, a: np.ndarray, min_points: int):
        """Totals of the segments from the boundaries `a` of `starts` to boundary `b` of this block."""
        P = np.vstack([starts.sums[a], self.sums[b][None, :]])
        tau = np.append(starts.tau[a], self.tau[b])
        costs = segment_costs(P, tau, np.arange(len(a)), len(a), self.factor)
        totals = (starts.best[a] + costs) + self.penalty
        if self.tau[b] < 2 * min_points:
            totals = np.where(starts.days[a] == ORIGIN, costs, totals)
        return totals

    def relax(self, starts: "Block", min_points: int) -> None:
        """Let every boundary take a better start from an earlier block."""
        alive = np.flatnonzero(np.isfinite(starts.best))
        for b in range(len(self.tau)):
            a = alive[(self.tau[b] - starts.tau[alive] >= min_points) & (self.tau[b] < starts.dead[alive])]
            if self.tau[b] >= min_points and len(a):
                self.take(b, starts, a, self.meet(starts, b, a, min_points))

    def take(self, b: int, starts: "Block", a: np.ndarray, totals: np.ndarray) -> None:
        m = int(np.argmin(totals))
        if totals[m] < self.best[b]:
            self.best[b], self.prev[b] = totals[m], starts.days[a[m]]

    def close(self, min_points: int) -> None:
        """The recurrence inside the block, after all earlier ones were met."""
        for b in range(len(self.tau)):
            if self.days[b] == ORIGIN or self.tau[b] < min_points:
                continue
            a = np.flatnonzero((self.tau[b] - self.tau[:b] >= min_points) & np.isfinite(self.best[:b]) & (self.tau[b] < self.dead[:b]))
            if not len(a):
                continue
            totals = self.meet(self, b, a, min_points)
            self.take(b, self, a, totals)
            margin = 1e-9 * (abs(self.best[b]) + self.penalty + 1.0)
            beaten = a[totals > self.best[b] + self.penalty + margin]
            self.dead[beaten] = np.minimum(self.dead[beaten], self.tau[b] + min_points)


def blocks_of(hist: DataFrame, key_cols: Sequence[str], block_days: int, schema: T.StructType) -> DataFrame:
    """(key..., `STATE`): one row per series and block, blocks numbered from 0; the first one also holds boundary 0."""
    keys = list(key_cols)
    rows = materialize(hist.select(*keys, "n", "k", F.datediff("fecha", F.expr(EPOCH)).alias("d"), "j", "cnt")
                       .withColumn("block", F.expr(f"cast(floor(d / {block_days}) as int)")))
    # sums of whole blocks, a row for each position, added up over the blocks before
    held = rows.groupBy(*keys, "block", "k", "j").agg(F.sum("cnt").alias("cnt"))
    grid = held.select(*keys, "block", "k").distinct()
    order = Window.partitionBy(*keys).orderBy("block")
    grid = grid.select(*keys, "block", "k", (F.row_number().over(order) - 1).alias("idx"),
                       F.count("*").over(Window.partitionBy(*keys)).cast("int").alias("blocks"))
    dense = grid.select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("j")).join(
        held.select(*keys, "block", "j", "cnt"), [*keys, "block", "j"], "left")
    before = Window.partitionBy(*keys, "j").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    start = dense.select(*keys, "block", "idx", "blocks", "j", F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("before"))
    start = start.groupBy(*keys, "block", "idx", "blocks").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "before"))), lambda x: x["before"]).alias("before"))

    def build(frame: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        n, k, first = int(frame["n"].iloc[0]), int(frame["k"].iloc[0]), int(at["idx"].iloc[0]) == 0
        days, P, tau = boundary_sums(frame["d"].to_numpy(np.int64), frame["j"].to_numpy(np.int64),
                                     frame["cnt"].to_numpy(np.float64), k)
        offset = np.array(at["before"].iloc[0], dtype=np.int64)  # points at each position before the block, k + 1 of them
        P, tau = P + np.cumsum(offset)[:k], tau + int(offset.sum()) // 2
        if first:
            days = np.concatenate([[ORIGIN], days])
        else:
            P, tau = P[1:], tau[1:]
        best = np.full(len(days), np.inf)
        block = Block(n, k, days.astype(np.int64), tau.astype(np.int64), P.astype(np.int64), best,
                      np.full(len(days), ORIGIN, dtype=np.int64), np.full(len(days), NEVER, dtype=np.int64))
        if first:
            best[0] = -block.penalty
        return pd.DataFrame([{**{c: frame[c].iloc[0] for c in keys}, "n": n, "k": k, "idx": int(at["idx"].iloc[0]),
                              "blocks": int(at["blocks"].iloc[0]), **block.written()}])

    start = start.toDF(*(f"{c}_s" if c in (*keys, "block") else c for c in start.columns))
    return (rows.groupBy(*keys, "block").cogroup(start.groupBy(*(f"{c}_s" for c in keys), "block_s"))
            .applyInPandas(build, _state(schema, keys)))


def _state(schema: T.StructType, keys: list[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name in keys] + T.StructType.fromDDL(STATE).fields)


def run_blocks(blocks: DataFrame, key_cols: Sequence[str], schema: T.StructType, min_points: int = MIN_POINTS) -> DataFrame:
    """The staged dynamic program over written blocks: (key..., idx, days, prev), closed."""
    keys, state = list(key_cols), _state(schema, list(key_cols))
    names = [f.name for f in state.fields]
    last = blocks.agg(F.max("idx")).first()[0]
    if last is None:
        return blocks.select(*keys, "idx", "days", "prev")

    def one(row, starts) -> dict:
        block = Block.read(row)
        if starts is not None:
            block.relax(starts, min_points)
        if row.idx == row.stage:
            block.close(min_points)
        return block.written()

    def stage(batches):
        for frame in batches:
            out = frame[names].copy()
            done = [one(r, Block.read(r, "_s") if "days_s" in frame.columns else None) for r in frame.itertuples(index=False)]
            for c in ("best", "prev", "dead"):
                out[c] = [d[c] for d in done]
            yield out

    binaries = ("days", "tau", "sums", "best", "prev", "dead")
    current = materialize(blocks.where("idx = 0").withColumn("stage", F.lit(0)).mapInPandas(stage, state))
    waiting, closed = blocks.where("idx > 0"), [current]
    for j in range(1, last + 1):
        source = current.where((F.col("idx") == j - 1) & (F.col("blocks") > j)).select(
            *keys, F.explode(F.sequence(F.lit(j), F.col("blocks") - 1)).alias("idx"), *(F.col(c).alias(c + "_s") for c in binaries))
        # spread by series and block: each pair of blocks meets in a task of its own
        met = waiting.join(source, [*keys, "idx"]).withColumn("stage", F.lit(j))
        current = materialize(met.mapInPandas(stage, state))
        closed.append(current)
        waiting = current.where(F.col("idx") > j)
    out = closed[0].select(*keys, "idx", "days", "prev")
    for j, table in enumerate(closed[1:], 1):
        out = out.unionByName(table.where(F.col("idx") == j).select(*keys, "idx", "days", "prev"))
    return out


def way_back(closed: DataFrame, key_cols: Sequence[str], schema: T.StructType) -> DataFrame:
    """(key..., change_point, status): the chosen starts from the end of each series, block by block backwards."""
    keys = list(key_cols)
    parts = int(closed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = T.StructType([f for f in schema.fields if f.name in keys] + [T.StructField("cp", T.IntegerType())])

    def walk(batches):
        last_key, cursor = None, None
        for frame in batches:
            if not len(frame):
                continue
            rows, found = [], []
            new = np.zeros(len(frame), dtype=bool)
            new[_key_starts(frame, keys)] = True
            key = tuple(frame[keys].iloc[0])
            new[0] = last_key is None or not all(a == b or (pd.isna(a) and pd.isna(b)) for a, b in zip(key, last_key))
            for r, (days, prev) in enumerate(zip(frame["days"], frame["prev"])):
                days, prev = np.frombuffer(days, dtype="<i8"), np.frombuffer(prev, dtype="<i8")
                if new[r]:
                    cursor = int(prev[-1])  # the start of the last segment
                while cursor != ORIGIN and cursor >= days[days != ORIGIN][0]:
                    rows.append(r)
                    found.append(cursor)
                    cursor = int(prev[np.searchsorted(days, cursor)])
            last_key = tuple(frame[keys].iloc[-1])
            out = frame.iloc[rows][keys].reset_index(drop=True)
            out["cp"] = pd.Series(found, dtype="int32")
            yield out

    out = (closed.repartition(parts, *keys).sortWithinPartitions(*keys, F.desc("idx"))
           .select(*keys, "days", "prev").mapInPandas(walk, mid))
    return out.select(*keys, F.date_add(F.expr(EPOCH), F.col("cp")).alias("change_point"), F.lit("ok").alias("status"))


def edpelt_blocks(series: DataFrame, key_cols: Sequence[str], block_days: int = 366, min_points: int = MIN_POINTS,
                  reuse: str = "table", rank_strategy: str = "auto") -> DataFrame:
    """T5 + T12 with the rows of `edpelt`, a series' dynamic program spread over tasks and stages by blocks of dates."""
    keys, schema = list(key_cols), result_schema(series, key_cols)
    blocks = materialize(blocks_of(_folded(series, keys, reuse, rank_strategy)[0], keys, block_days, schema), reuse)
    return way_back(run_blocks(blocks, keys, schema, min_points), keys, schema)
