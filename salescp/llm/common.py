"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salescp.session import Rounds, materialize

WHITE = "\t\n\x0b\x0c\r "  # the characters [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(col: str, parts: int):
    """crc32 of the id written as text, modulo `parts` (null id: null)."""
    return F.expr(f"pmod(crc32(cast(cast({col} as string) as binary)), {parts})")


def worker_store(name: str) -> dict:
    """A dict that outlives a task in its Python worker (functions travel by value, so
    their module globals do not).  Only for caches that can be rebuilt at any time; a
    worker that goes on to another operator lets go of the last one's."""
    module = sys.modules.setdefault("_salescp_worker_store", types.ModuleType("_salescp_worker_store"))
    held = module.__dict__.get("held")
    if held is None or held[0] != name:
        module.held = held = (name, {})
    return held[1]


def let_go() -> None:
    """Give memory that is free in this worker back to the system: workers outlive their tasks, and
    Arrow's pool and the C library else keep what a task has used."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def slices_of_rows(batch, at: int, limit: int):
    """An Arrow batch in slices of rows whose column `at` (text) has about `limit` bytes, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), dtype=np.int64))
    start = 0
    while start < len(size) or not start:  # an empty batch is one slice
        done = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (a, b).

    Alternating large-star and small-star rounds; each round is one shuffle per
    star, written to the shared checkpoint folder, until the edge set is a set
    of stars.  Rows with a null end and loops are ignored.  Nodes without an
    edge do not appear.  The number of rounds grows with the logarithm of the
    longest path; exceeding `max_rounds` raises.
    """
    def written(df):
        seen = Observation()
        out = materialize(df.observe(seen, F.count("*").alias("n"),
                                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        return out, (seen.get["n"], seen.get["h"])

    rounds = Rounds(edges.sparkSession)  # a round's table goes when the next one is written
    with rounds.next():
        cur, before = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for _ in range(max_rounds):
        # large star: a node's neighbours above it go to the smallest of the node and its neighbours
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = cur.select(F.col("u").alias("x"), F.col("v").alias("u")).join(low, "u").selectExpr("x as u", "m as v").distinct()
        # small star: a node's lower neighbours and the node itself go to its smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                               F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        with rounds.next():
            cur, now = written(small)
        if now == before:
            rounds.done()
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
