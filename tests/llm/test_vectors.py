"""Multi-index search (1) and cap filters (10) against brute force."""

import math

import numpy as np
import pytest
from conftest import SF_ORACLE

from salescp.llm import cap_filters, multi_index, queries

ODD = [(1, None, 1), (3, [0.0, 0.0], 1), (5, [1.0, None], 1), (7, [math.nan, 1.0], 1), (9, [math.inf, 1.0], 1), (11, [], 1),
       (13, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "c", "x", "f", "part", "cell", "rank", "links", "component"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_walk_meets_cells_in_order():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b, n = rng.normal(size=5), rng.normal(size=7), rng.integers(0, 4, 35)
        cells = multi_index.walk(a, b, n, int(n.sum()))
        order = np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")
        assert cells == [c for c in order.tolist() if n[c]]
        some = multi_index.walk(a, b, n, 5)
        assert some == cells[:len(some)] and n[some].sum() >= min(5, n.sum())


def test_search_recall_on_the_table(spark):
    got = queries.op1_multi_index(spark, SF_ORACLE).toPandas()
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    hit = 0
    for q, part in got.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21))
        assert np.allclose(part.score, [score[ids == v][0] for v in part.vec_id], rtol=0, atol=1e-12)
        assert sorted(zip(-part.score, part.vec_id)) == list(zip(-part.score, part.vec_id))
        hit += len(set(best) & set(part.vec_id))
    queries_there = (ids % 20 == 0).sum()
    assert got.query_id.nunique() == queries_there and hit / (20 * queries_there) >= 0.9


def test_search_odd_rows_ties_and_few_candidates(spark):
    rows = ODD + [(20, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (4, [0.5, 0.5], 1), (4, [0.5, 0.5], 1), (6, [-1.0, 0.0], None), (40, [0.0, 2.0], 2)]
    got = multi_index.search(frame(spark, rows), "id % 20 = 0", scan=1.0, shard_rows=2, query_rows=1).collect()
    by = {q: [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (20, 40)}
    assert by[20] == [(1, 2, 0.5), (2, 4, 0.5), (3, 40, 0.0), (4, 6, -1.0)]
    assert by[40] == [(1, 2, 1.0), (2, 4, 1.0), (3, 6, 0.0), (4, 20, 0.0)]
    assert {r.query_id for r in got} == {20, 40}
    assert multi_index.search(frame(spark, []), "id % 20 = 0").collect() == []


def test_search_gives_all_candidates_if_few(spark):
    rng = np.random.default_rng(8)
    for count in (6, 30):
        rows = [(20 + k, rng.normal(size=4).tolist(), 1) for k in range(count)]
        got = multi_index.search(frame(spark, rows), "id % 20 = 0").collect()  # with the registered scan
        per = {q: sorted(r["rank"] for r in got if r.query_id == q) for q in (i for i, _, _ in rows if i % 20 == 0)}
        assert all(ranks == list(range(1, min(20, count - 1) + 1)) for ranks in per.values())


def test_search_takes_every_row_of_an_id_and_products_beyond_a_double(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.1, 0.9], 1), (3, [0.5, 0.0], 1), (0, [0.0, 3.0], 1), (20, [1e200, 1e200], 1),
            (21, [1e200, 2e200], 1), (22, [-1e200, 0.0], 1)]
    wide = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = multi_index.search(wide, "id % 20 = 0", n=3).collect()
    first = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0)
    assert [x for x in first if x[0] == 1] == [(1, 20, 1e200), (1, 21, 6e200)] and len(first) == 6
    top = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 20)
    assert [(a, b) for a, b, _ in top] == [(1, 21), (2, 0), (3, 1)] and top[0][2] == np.inf
    few = multi_index.search(wide.where("vec_id < 20 and embedding[1] < 3"), "id % 20 = 0").collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in few) == [(1, 1, 1.0), (2, 3, 0.5), (3, 1, 0.1)]


def test_decoding_large_codes_takes_bounded_memory():
    import tracemalloc

    code, x = cap_filters.ProductCode(64, 4096, 24.0), cap_filters.unit_rows(np.random.default_rng(1), 3000, 64)
    tracemalloc.start()
    lists = code.decode(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lists) == 3000 and peak < 300e6


def test_list_decoding_is_every_exceeding_filter():
    code, rng = cap_filters.ProductCode(16, 12, 10.0, least=2), np.random.default_rng(3)
    x = cap_filters.unit_rows(rng, 40, 16)
    y = (x @ code.turn) * 0.5 ** 0.5
    all_products = (y[:, :8] @ code.code[0].T)[:, :, None] + (y[:, 8:] @ code.code[1].T)[:, None, :]
    for row, filters in zip(all_products.reshape(40, -1), code.decode(x)):
        over = set(np.flatnonzero(row >= code.threshold).tolist())
        assert over <= set(filters.tolist()) and len(filters) >= 2


@pytest.mark.parametrize("m", [16, 1000, 4096])
def test_lists_and_recall_hold_for_large_codes(m):
    # d = 64: the mean list is `lists`, and pairs at the least cosine share a filter, whatever the size of the code
    codes = cap_filters.codes_needed(64, m, 24, 0.93, 0.999)
    x, y = cap_filters.random_pairs(np.random.default_rng(5), 600, 64, 0.93)
    assert np.allclose((x * y).sum(axis=1), 0.93)
    one = cap_filters.ProductCode(64, m, 24, least=0)
    assert 21 <= np.mean([len(f) for f in one.decode(np.concatenate([x, y]))]) <= 27
    filters = cap_filters.Filters(64, m, 24, codes)
    a, b = filters.decode(x), filters.decode(y)
    assert all((np.diff(f) > 0).all() for f in a)
    assert np.mean([len(np.intersect1d(f, g)) > 0 for f, g in zip(a, b)]) >= 0.995


def test_cap_quantile_is_exact():
    assert math.isclose(cap_filters.cap_quantile(2, 1 / 3), 0.5, abs_tol=1e-6)  # an arc
    assert math.isclose(cap_filters.cap_quantile(3, 1e-5), 1 - 2e-5, abs_tol=1e-9)  # a cap of the sphere is linear in its height
    assert math.isclose(cap_filters.cap_quantile(64, 0.5), 0, abs_tol=1e-9)


def test_codes_without_a_recall_hold_all_in_one_filter(spark):
    assert cap_filters.codes_needed(64, 16, 24, -1.0, 0.999) == 0
    x = cap_filters.unit_rows(np.random.default_rng(1), 3, 64)
    assert [f.tolist() for f in cap_filters.Filters(64, 16, 24, 0).decode(x)] == [[0]] * 3


def plain_links(rows, least=0.93):
    ok = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)
          and any(v)]
    n, root = [0] * len(rows), list(range(len(rows)))
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    n[a] += 1
                    n[b] += 1
                    root = [root[a] if r == root[b] else r for r in root]
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    return sorted((str(i), n[k], str(None if i is None else low[root[k]])) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("block", [2048, 7])
def test_cap_filters_equal_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = list(ODD)
    for label in (1, 2, None):
        for _ in range(12):
            centre = rng.normal(size=24)
            for _ in range(int(rng.choice([1, 2, 3, 25]))):
                rows.append((len(rows) + 100, (centre + rng.normal(size=24) * 0.2).tolist(), label))
    rows += [(i, v, lab) for i, v, lab in rows[-5:]]  # repeated rows
    rows += [(900 + k, rows[20][1], rows[20][2]) for k in range(30)]  # exact copies
    got = cap_filters.near_duplicates(frame(spark, rows), block=block).collect()
    expect = plain_links(rows)
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)
    assert [(a, c) for a, _, c in found] == [(a, c) for a, _, c in expect]
    assert sum(n for _, n, _ in found) >= 0.99 * sum(n for _, n, _ in expect)
    assert all(a[1] <= b[1] for a, b in zip(found, expect))  # no link below the threshold
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_cap_filters_of_nothing(spark):
    assert cap_filters.near_duplicates(frame(spark, [])).collect() == []
    alone = cap_filters.near_duplicates(frame(spark, ODD)).collect()
    assert {r.n_links for r in alone} == {0} and len(alone) == len(ODD)


def test_components_of_paths_and_cycles(spark):
    from salescp.llm.common import components

    edges = [(k, k + 1) for k in range(50, 120)] + [(1, 2), (2, 3), (3, 1), (9, 9), (None, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 50 for k in range(50, 121)}, 1: 1, 2: 1, 3: 1}
