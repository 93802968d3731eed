"""Approximate nearest neighbours by an inverted multi-index.

The two halves of each vector are quantised separately by `k` centroids; a
vector is filed under its pair of centroids.  A query walks the pairs by the
summed distance of its halves (for inner products: the negative product with
the centroid), with a heap over the two sorted lists, until the pairs it has
met hold `scan` of all vectors, and at least n besides the query; the vectors
filed there are ranked by their exact inner product in double precision.

Scale.  Centroids are learned from a bounded sample (`sample_values` numbers,
the rows of smallest id hash); the index has every row.  Only the k * k pair
counts and the centroids are broadcast.  Vectors are dealt by id hash into
shards of about `shard_rows`, queries into blocks of `query_rows`; a task meets
one block with one shard and returns the block's best of it, so a pair of
centroids that a third of all vectors share is spread over all shards, and no
task holds more than a block and a shard.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do rows with a null id, nor vectors of
another length than the most frequent one (ties: the longer); rows of one
id with different vectors are candidates and queries of their own (a query row is
not its own candidate, another row with its id is), rows equal in both stand for
one; ties go to the smaller id.  Products beyond the
range of a double are ordered by wider numbers and returned as infinite.  An empty
table gives no rows; columns other than id and vector are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescp.session import materialize

from .vectors import matrix, usable


def centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """k-means of the rows; fewer rows than k are their own centroids."""
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    c = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in ascending summed distance until they hold `wanted` entries (or all cells)."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    u, v = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    width, cells, held = len(b), [], 0
    heap = [(u[0] + v[0], 0, 0)]
    counts = counts.tolist()
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if j + 1 < width:
            heapq.heappush(heap, (u[i] + v[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):  # each pair is reached along its row only
            heapq.heappush(heap, (u[i + 1] + v[0], i + 1, 0))
    return cells


def search(vectors: DataFrame, queries, n: int = 20, k: int = 64, scan: float = 0.5, id_col: str = "vec_id",
           vec_col: str = "embedding", sample_values: int = 1_000_000, shard_rows: int = 8192,
           query_rows: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score) for the vectors whose id fulfils `queries` (SQL over `id`), against all others."""
    spark = vectors.sparkSession
    rows = materialize(vectors.where(usable(vec_col) & F.col(id_col).isNotNull())
                       .select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).distinct()
                       .withColumn("row", F.monotonically_increasing_id()))  # written, so a row keeps its number
    lengths = sorted((r["n"], r["d"]) for r in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect())
    kind = rows.schema["id"].dataType.simpleString()
    if not lengths:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    total, d = lengths[-1]
    rows = rows.where(F.size("v") == d)
    sample = np.array([r["v"] for r in rows.select("id", "v", F.xxhash64("id").alias("h")).orderBy("h", "id", "v")
                      .limit(max(256, sample_values // d)).collect()])
    half = (d + 1) // 2
    scale = 2.0 ** np.floor(np.log2(np.abs(sample).max()))  # vectors are filed in these units, so that squares stay in range
    sample = sample / scale
    books = centroids(sample[:, :half], k), centroids(sample[:, half:], k) if d > 1 else np.zeros((1, 0))
    n_cells = len(books[0]) * len(books[1])
    shards, blocks = -(-total // shard_rows), None
    shared = spark.sparkContext.broadcast(books)

    def file(batches):
        one, two = shared.value
        for f in batches:
            if len(f):
                x = np.stack(f["v"].to_numpy())
                y = x / scale
                cell = nearest(y[:, :half], one) * len(two) + nearest(y[:, half:], two)
                yield pd.DataFrame({"id": f["id"], "row": f["row"], "cell": cell, "x": [r.astype("<f8").tobytes() for r in x]})

    index = materialize(rows.mapInPandas(file, f"id {kind}, row bigint, cell int, x binary"))
    counts = np.zeros(n_cells, dtype=np.int64)
    for r in index.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most k * k rows
        counts[r["cell"]] = r["n"]
    wanted = min(total, max(int(np.ceil(scan * total)), n + 1))  # n besides the query itself
    asked = index.where(queries)
    blocks = max(1, -(-asked.count() // query_rows))

    def plan(batches):
        one, two = shared.value
        for f in batches:
            cells = []
            for q in matrix(f["x"]) / scale if len(f) else []:
                seen = np.zeros(n_cells, dtype=bool)
                seen[walk(-(one @ q[:half]), -(two @ q[half:]), counts, wanted)] = True
                cells.append(np.packbits(seen).tobytes())
            yield pd.DataFrame({"id": f["id"], "row": f["row"], "x": f["x"], "cells": cells})

    planned = (asked.select("id", "row", "x").mapInPandas(plan, f"id {kind}, row bigint, x binary, cells binary")
               .withColumn("block", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)).cast("int"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    dealt = (index.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def meet(asks, entries):
        empty = pd.DataFrame({"query_id": asks["id"][:0], "query_row": asks["row"][:0], "vec_id": entries["id"][:0], "score": np.zeros(0)})
        if not len(asks) or not len(entries):
            return empty
        entries = entries.sort_values("cell", kind="stable")
        q, x, ids, q_ids = matrix(asks["x"]), matrix(entries["x"]), entries["id"].to_numpy(), asks["id"].to_numpy()
        of_row, q_rows = entries["row"].to_numpy(), asks["row"].to_numpy()
        seen = np.unpackbits(np.stack([np.frombuffer(c, dtype=np.uint8) for c in asks["cells"]]), axis=1).astype(bool)
        cell = entries["cell"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        score = np.full((len(q), len(x)), -np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            for a, b in zip(cuts[:-1], cuts[1:]):
                who = np.flatnonzero(seen[:, cell[a]])
                score[who, a:b] = q[who] @ x[a:b].T
            out = []
            for k_, row in enumerate(score):
                met = np.flatnonzero(seen[k_, cell] & (of_row != q_rows[k_]))
                row = row[met]
                if not np.isfinite(row).all():  # beyond the range of a double: in wider numbers
                    row = (x[met].astype(np.longdouble) * q[k_]).sum(axis=1)
                last = np.partition(row, -n)[-n] if len(row) > n else -np.inf
                near = met[row >= last - 1e-9 * max(1.0, abs(last))] if last > -np.inf else met
                exact = (x[near] * q[k_]).sum(axis=1)  # the same order of additions for every row
                by = exact if np.isfinite(exact).all() else (x[near].astype(np.longdouble) * q[k_]).sum(axis=1)
                best = np.lexsort((ids[near], -by))[:n]
                out.append(pd.DataFrame({"query_id": q_ids[k_], "query_row": q_rows[k_], "vec_id": ids[near[best]],
                                         "score": by[best].astype(np.float64)}))
        return pd.concat([empty, *out]) if out else empty

    best = (planned.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard"))
            .applyInPandas(meet, f"query_id {kind}, query_row bigint, vec_id {kind}, score double"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= n).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
