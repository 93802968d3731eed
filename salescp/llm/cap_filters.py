"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector is in it when their product exceeds a
threshold.  The directions are a structured random product code: after a random
rotation the space is cut in two, each half has `m` random unit vectors, and
every pair of them is a direction, m * m in all.  A vector is list-decoded to all
directions over the threshold by sorting its products with each half's code and
walking the pairs from the top, without looking at the others; it also keeps its
`least` best directions, so that no vector is without one.  Vectors of one label
that share a filter are verified by their exact cosine.

The code grows with the square root of its label's entries (a power of two from 8
to 4096, for each label and length), and the threshold is the exact cap that a
random vector passes in `lists` directions on average, so a filter holds about
`lists` unrelated vectors of a label up to 16 million entries, and more in
proportion above.  One code misses more pairs the larger it is; so a label takes
as many independent codes as it needs for a random pair at the least cosine to
share a filter with probability `recall`, measured on `PAIRS` random pairs for each
size of code (pairs above the least cosine are found more often).  A label that
would need more than `MOST_CODES` has one filter, with all its vectors.

Scale.  Equal vectors of a label are one entry with a multiplicity.  Filters of
neighbouring numbers, which share directions and so many entries, are verified
in one bundle, to which an entry goes once.  A filter with more than `block`
entries is cut in blocks, and each pair of blocks is a task.  A pair that
shares several filters is counted in the first of them only.
Tasks return one row per entry (its number of links there and the smallest
entry it is connected with), never the pairs.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows with a null label or id, link with nothing:
no link, their own component, kept (null id: null component, not kept);
vectors of different length do not link; rows that repeat an id are vectors of
their own with that id; an empty table gives no rows; columns other than id,
vector and label are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescp.session import materialize

from .common import components
from .vectors import matrix, unit_rows, usable


PAIRS, MOST_CODES, DECODED = 2000, 100, 256


def cap_quantile(d: int, share: float) -> float:
    """The product with a fixed direction that this share of all unit vectors of d components exceeds."""
    if d == 1:
        return 0.0
    angle = np.linspace(0, np.pi, 200_001)
    density = np.sin(angle) ** (d - 2)
    area = np.concatenate([[0.0], np.cumsum(density[1:] + density[:-1])])
    return float(np.cos(np.interp(share, area / area[-1], angle)))


class ProductCode:
    """m * m filter directions for vectors of d components, and their list decoding."""

    def __init__(self, d: int, m: int, lists: float, least: int = 8, seed: int = 20):
        rng = np.random.default_rng([seed, d, m])
        self.half, self.m, self.least = (d + 1) // 2, m, min(least, m)
        self.turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        # a half of one component has two directions
        self.code = tuple(unit_rows(rng, m, h) if h > 1 else np.array([[1.0], [-1.0]]) if h else np.zeros((1, 0))
                          for h in (self.half, d - self.half))
        self.size = len(self.code[0]) * len(self.code[1])
        self.threshold = cap_quantile(d, min(0.5, lists / self.size))

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Sorted numbers of each unit row's filters; works on `DECODED` rows at a time, about 64 MB at m = 4096."""
        return [f for at in range(0, len(x), DECODED) for f in self._decode(x[at:at + DECODED])]

    def _decode(self, x: np.ndarray) -> list[np.ndarray]:
        y = (x @ self.turn) * 0.5 ** 0.5
        one, two = y[:, :self.half] @ self.code[0].T, y[:, self.half:] @ self.code[1].T
        width, out = len(self.code[1]), []
        a, b = np.argsort(-one, axis=1, kind="stable"), np.argsort(-two, axis=1, kind="stable")
        u, v = np.take_along_axis(one, a, axis=1), np.take_along_axis(two, b, axis=1)
        for k in range(len(x)):
            # how many of the second half's code go with each of the first's
            reach = np.searchsorted(-v[k], u[k] - self.threshold, side="right")
            reach = np.concatenate([np.repeat(a[k, :np.count_nonzero(reach)], reach[reach > 0]) * width
                                    + b[k][np.concatenate([np.arange(r) for r in reach[reach > 0]])]]) \
                if reach.any() else np.zeros(0, dtype=np.int64)
            top = self.least
            best = (u[k, :top, None] + v[k, None, :top]).ravel().argsort(kind="stable")[::-1][:top]
            more = a[k][best // min(top, width)] * width + b[k][best % min(top, width)]
            out.append(np.unique(np.concatenate([reach, more])))
        return out


class Filters:
    """Independent product codes, their filters numbered one after another; without a code: one filter for all."""

    def __init__(self, d: int, m: int, lists: float, codes: int):
        self.codes = [ProductCode(d, m, lists, seed=20 + k) for k in range(codes)]

    @property
    def size(self) -> int:
        return max(1, sum(code.size for code in self.codes))

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        if not self.codes:
            return [np.zeros(1, dtype=np.int64)] * len(x)
        each = [code.decode(x) for code in self.codes]
        return [np.concatenate([f + k * code.size for k, (code, f) in enumerate(zip(self.codes, fs))]) for fs in zip(*each)]


def random_pairs(rng, n: int, d: int, cosine: float):
    """n pairs of unit vectors with this cosine."""
    x, z = unit_rows(rng, n, d), rng.normal(size=(n, d))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    return x, cosine * x + (1 - cosine * cosine) ** 0.5 * z / np.linalg.norm(z, axis=1, keepdims=True)


def codes_needed(d: int, m: int, lists: float, least: float, recall: float) -> int:
    """Codes with which a random pair at cosine `least` shares a filter with probability `recall`; 0: too many.

    Codes are turned independently, so the shares of pairs that they miss multiply.
    """
    if d == 1 or least >= 1:
        return 1
    x, y = random_pairs(np.random.default_rng([1, d, m]), PAIRS, d, max(least, -1.0))
    missed = 1.0
    for k in range(MOST_CODES):
        code = ProductCode(d, m, lists, seed=20 + k)
        apart = sum(not np.intersect1d(f, g, assume_unique=True).size for f, g in zip(code.decode(x), code.decode(y)))
        missed *= (apart + 1) / (PAIRS + 1)
        if missed <= 1 - recall:
            return k + 1
    return 0


def _spanning(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray):
    """Smallest position connected with each of `rows` and `columns` by a matrix of links."""
    low_r, low_c = rows.copy(), columns.copy()
    far = np.iinfo(np.int64).max
    while True:
        new_r = np.minimum(low_r, np.where(linked, low_c[None, :], far).min(axis=1, initial=far))
        new_c = np.minimum(low_c, np.where(linked, new_r[:, None], far).min(axis=0, initial=far))
        if (new_r == low_r).all() and (new_c == low_c).all():
            return new_r, new_c
        low_r, low_c = new_r, new_c


def _share_earlier(f: int, filters_x, filters_y) -> np.ndarray:
    """Which pairs have a filter before f in common."""
    owner = np.repeat(np.arange(len(filters_x) + len(filters_y)), [len(fs) for fs in (*filters_x, *filters_y)])
    filters = np.concatenate([*filters_x, *filters_y])
    known, place = np.unique(filters[filters < f], return_inverse=True)
    mark = np.zeros((len(filters_x) + len(filters_y), len(known)), dtype=np.float32)
    mark[owner[filters < f], place] = 1
    return mark[:len(filters_x)] @ mark[len(filters_x):].T > 0


def verify(f: int, x, y, weight_x, weight_y, names_x, names_y, filters_x, filters_y, least: float, same: bool):
    """Links of filter f between two blocks: (names, links counted here, smallest name connected)."""
    cosine = x @ y.T
    linked = cosine >= least
    near = np.abs(cosine - least) < 1e-9
    if near.any():  # at the threshold: one order of additions for every pair
        i, j = np.nonzero(near)
        linked[i, j] = (x[i] * y[j]).sum(axis=1) >= least
    if same:
        linked &= ~np.eye(len(x), dtype=bool)
    if not linked.any():
        names = names_x if same else np.concatenate([names_x, names_y])
        return names, np.zeros(len(names), dtype=np.int64), names
    # pairs that share an earlier filter are counted there
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    counted = linked.copy()
    counted[np.ix_(rows, columns)] &= ~_share_earlier(f, [filters_x[k] for k in rows], [filters_y[k] for k in columns])
    low_x, low_y = _spanning(linked, names_x, names_y)
    if same:
        return names_x, counted @ weight_y, np.minimum(low_x, low_y)
    return (np.concatenate([names_x, names_y]), np.concatenate([counted @ weight_y, counted.T @ weight_x]),
            np.concatenate([low_x, low_y]))


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", lists: float = 24, block: int = 2048, recall: float = 0.999) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row; `recall`: of pairs at the least cosine."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.when(usable(vec_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull(),
                                 F.col(vec_col).cast("array<double>")).alias("v"))
    rows = rows.withColumn("c", F.when(F.col("v").isNotNull(), F.xxhash64("label", F.size("v"), "v")))
    entries = materialize(rows.where("c is not null").groupBy("c", "label")
                          .agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v")))
    # the size of a label's code, the nearest power of two to the square root of its entries
    shapes = materialize(entries.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("n"), F.expr(
        "cast(greatest(8, least(4096, pow(2, round(log2(count(*)) / 2)))) as int)").alias("m")))
    target = 32 * block  # entries of filters verified together

    def calibrate(batches):
        for f in batches:
            yield f.assign(codes=[codes_needed(int(d), int(m), lists, least, recall) for d, m in zip(f["d"], f["m"])])

    codes = {(r["d"], r["m"]): r["codes"] for r in shapes.select("d", "m").distinct()  # ten sizes for each length
             .mapInPandas(calibrate, "d int, m int, codes int").collect()}

    def decode(batches):
        made: dict[tuple[int, int], Filters] = {}
        for f in batches:
            out = []
            for (d, m, n), part in f.groupby(["d", "m", "n"], sort=False):
                x = np.stack(part["v"].to_numpy())
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norms
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                shape = int(d), int(m)
                if shape not in made:
                    made[shape] = Filters(*shape, lists, codes[shape])
                units = -(-int(n) * lists * max(1, codes[shape]) // target)
                part = part[["c", "label", "weight", "d"]].assign(
                    span=max(1, int(made[shape].size // units)), x=[r.astype("<f8").tobytes() for r in x],
                    filters=made[shape].decode(x))
                out.append(part)
            if out:
                yield pd.concat(out)[["c", "label", "d", "span", "weight", "x", "filters"]]

    kind = rows.schema["label"].dataType.simpleString()
    shaped = entries.withColumn("d", F.size("v")).join(shapes, ["label", "d"])
    decoded = materialize(shaped.mapInPandas(
        decode, f"c bigint, label {kind}, d int, span int, weight bigint, x binary, filters array<int>"))
    posted = decoded.select("c", "label", "d", "span", F.explode("filters").alias("f"))
    sizes = materialize(posted.groupBy("label", "d", "f")
                        .agg(F.count("*").alias("n"), F.expr("f div first(span)").alias("unit"))
                        .where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    volume = sizes.agg(F.sum("n")).first()[0] or 0
    bundles = max(1, volume // target)
    # a unit of neighbouring filters goes to one bundle, a crowded one is dealt by filter
    crowded = (sizes.where("blocks = 1").groupBy("label", "d", "unit")
               .agg(F.ceil(F.sum("n") / (4 * target)).cast("int").alias("deals")).where("deals > 1"))
    large, deal = F.col("blocks") > 1, F.pmod(F.xxhash64("f"), F.coalesce("deals", F.lit(1)))
    bundle = F.when(large, F.xxhash64("label", "d", "f")).otherwise(
        F.pmod(F.xxhash64("label", "d", "unit", deal), F.lit(bundles)))
    placed = (sizes.join(crowded, ["label", "d", "unit"], "left")
              .select("label", "d", "f", "blocks", large.alias("large"), bundle.alias("bundle")))
    joined = posted.join(placed, ["label", "d", "f"]).withColumn("part", F.pmod("c", F.col("blocks")).cast("int"))
    tasks = joined.select("*", F.explode(F.expr(
        "transform(sequence(0, blocks - 1), p -> struct(least(p, part) as i, greatest(p, part) as j))")).alias("t"))
    asked = (tasks.groupBy("c", "label", "large", "bundle", "part", F.col("t.i").alias("i"), F.col("t.j").alias("j"))
             .agg(F.collect_list("f").alias("here")))
    keyed = asked.join(decoded.select("c", "label", "d", "weight", "x", "filters"), ["c", "label"])

    def check(key, frame):
        out = []
        for _, g in frame.groupby(["label", "d"], sort=False, dropna=False):
            x, filters, part = matrix(g["x"]), list(g["filters"]), g["part"].to_numpy()
            names, weight, across = g["c"].to_numpy(), g["weight"].to_numpy(), g["i"].iloc[0] != g["j"].iloc[0]
            f = np.concatenate(list(g["here"]))
            order = np.argsort(f, kind="stable")
            row, f = np.repeat(np.arange(len(g)), [len(h) for h in g["here"]])[order], f[order]
            cuts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1], [True])))
            for start, end in zip(cuts[:-1], cuts[1:]):
                a = b = row[start:end]
                if across:
                    a, b = a[part[a] == g["i"].iloc[0]], a[part[a] == g["j"].iloc[0]]
                if not len(a) or not len(b):
                    continue
                low_of, links, low = verify(int(f[start]), x[a], x[b], weight[a], weight[b], names[a], names[b],
                                            [filters[k] for k in a], [filters[k] for k in b], least, not across)
                some = (links > 0) | (low != low_of)
                if some.any():
                    out.append((low_of[some], links[some], low[some]))
        c, links, low = (np.concatenate(z) for z in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3
        return pd.DataFrame({"c": c, "links": links, "low": pd.array(low, dtype="Int64")}).assign(
            low=lambda t: t["low"].mask(t["low"] == t["c"]))

    checked = materialize(keyed.groupBy("large", "bundle", "i", "j").applyInPandas(check, "c bigint, links bigint, low bigint"))
    counts = checked.groupBy("c").agg(F.sum("links").alias("links"))
    joined = components(checked.where("low is not null").select(F.col("c").alias("a"), F.col("low").alias("b")))
    known = (entries.select("c", "rep", "weight").join(joined, F.col("c") == F.col("node"), "left").drop("node")
             .join(counts, "c", "left").withColumn("root", F.coalesce("component", "c")))
    of_entry = (known.join(known.groupBy("root").agg(F.min("rep").alias("component_id")), "root")
                .select(F.col("c").alias("_c"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")))
    return (rows.select("id", "c").join(of_entry, F.col("c") == F.col("_c"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
