"""Fact reduction before a shuffle, tagged union, byte-bounded broadcasts, rejected lines and file order."""

import random
import re

import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from salescp.operators import enrich as N
from salescp.operators import reduce as R
from salescp.operators.enrich import enrich
from salescp.operators.tagged import enrich_tagged, tagged_left
from salescp.params import Filters
from salescp.plans.queries import doubled_star
from salescp.sources import fixtures, text

FIX = Filters.fixture()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("bits", [R.ROW_BITS, 1 << 18, R.FILTER_BITS])
def test_a_bitmap_keeps_every_partner(spark, bits):
    rng = random.Random(bits)
    keys = {rng.choice([rng.randint(-50, 50), rng.getrandbits(62), -rng.getrandbits(62)]) for _ in range(400)}
    dim = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k bigint")
    facts = spark.createDataFrame([(k, 1) for k in keys] + [(rng.getrandbits(60), 0) for _ in range(4000)] + [(None, 0)], "k bigint, real int")
    got = R.reduce_facts(facts, dim, "k", bits).groupBy("real").count().collect()
    kept = {r.real: r["count"] for r in got}
    assert kept[1] == len(keys) and kept.get(0, 0) <= 4000 * (4 * len(keys) / bits + 0.01)
    ints = facts.withColumn("k", F.col("k").try_cast("int")).where("k between -50 and 50 and real = 1")
    assert R.reduce_facts(ints, dim, "k", bits).count() == ints.count()  # an int key meets a bigint one
    words = facts.withColumn("k", F.col("k").cast("string"))
    assert R.reduce_facts(words, dim, "k") is words


def test_the_fact_table_is_reduced_below_the_exchange(spark):
    v, p, l = fixtures.star(spark, SF_ORACLE)
    large = enrich(v, p, l, "inner", FIX, broadcast_max_rows=0)
    assert rows(large) == rows(enrich(v, p, l, "inner", FIX))
    plan = large._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin) .*?(Inner|LeftSemi)", plan)
    assert joins == [("SortMergeJoin", "Inner")] * 2 + [("BroadcastHashJoin", "LeftSemi")] * 2
    executed = large._jdf.queryExecution().executedPlan().toString()
    assert executed.index("SortMergeJoin") < executed.index("Exchange hashpartitioning(clave") < executed.index("LeftSemi")
    left = enrich(v, p, l, "left", FIX, broadcast_max_rows=0)  # keeps every sale, so nothing is reduced
    assert "LeftSemi" not in left._jdf.queryExecution().sparkPlan().toString() and rows(left) == rows(enrich(v, p, l, "left", FIX))


def test_a_broadcast_is_bounded_by_bytes_too(spark):
    wide = spark.range(100).select(F.col("id").alias("clave"), F.repeat(F.lit("x"), 10_000).alias("categoria"))
    (_, fits), (_, small) = N.written_sides([wide, wide.withColumn("categoria", F.lit("y"))], 1000, 500_000)
    assert (fits, small) == (False, True)
    (_, fits), = N.written_sides([wide], 1000, 2_000_000)
    assert fits
    (_, fits), = N.written_sides([wide], 99, 2_000_000)
    assert not fits


@pytest.mark.parametrize("deals", [1, 5])
def test_tagged_union_equals_the_left_joins(spark, deals):
    v, p, l = doubled_star(spark, SF_ORACLE)
    odd = v.limit(3).withColumn("clave_producto", F.lit(None).cast("bigint"))
    v = v.unionByName(odd)
    assert rows(enrich_tagged(v, p, l, FIX, deals)) == rows(enrich(v, p, l, "left", FIX))


def test_tagged_union_has_one_exchange_and_splits_a_hot_product(spark):
    sales = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("s"))
    dim = spark.createDataFrame([(7, "seven"), (7, "aaa"), (20, "twenty")], "clave bigint, name string")
    out = tagged_left(sales, dim, "k", "name", deals=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert {r.name: r["count"] for r in out.groupBy("name").count().collect()} == {"seven": 18_000, "twenty": 1, "": 1999}
    parts = sales.withColumn("p", F.pmod(F.xxhash64("k", "s"), F.lit(16))).where("k = 7").groupBy("p").count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 18_000 / 10


def test_rejected_lines_with_reason_and_place(spark, tmp_path):
    folder = tmp_path / "ventas"
    folder.mkdir()
    good = "1;2;2024-01-05;2;2;189.9;900001"
    a = [good, "header;x", "x;2;2024-01-05;2;2;189.9;9", good, "1;2;no date;2;2;189.9;900002", "1;2;2024-01-05;2;dos;189.9;9", ""]
    (folder / "a.csv").write_text("\n".join(a) + "\n")
    (folder / "b.csv").write_text("1;2;2024-01-05;2;2;caro;9\n" + good + "\n")
    (folder / "c.csv").write_text("")
    found = text.quarantine(spark, str(folder), text.VENTAS_LAYOUT)
    got = sorted((r.file.rsplit("/", 1)[1], r.block, r.line, r.reason, r.value) for r in found.rejects.collect())
    assert got == [("a.csv", 0, 1, "short line", "header;x"), ("a.csv", 0, 2, "bad clave_local", a[2]),
                   ("a.csv", 0, 5, "bad cant_vta", a[5]), ("a.csv", 0, 6, "short line", ""),
                   ("b.csv", 0, 0, "bad precio_unitario", "1;2;2024-01-05;2;2;caro;9")]
    assert sorted((r.file[-5:], r.line, r.fecha) for r in found.rows.collect()) == [
        ("a.csv", 0, "2024-01-05"), ("a.csv", 3, "2024-01-05"), ("a.csv", 4, "no date"), ("b.csv", 1, "2024-01-05")]
    parsed = text.read_ventas(spark, str(folder)).rows
    assert rows(parsed) == rows(found.rows.select(*parsed.columns))


def test_both_outcomes_come_from_one_scan_of_the_text(spark, tmp_path):
    path = tmp_path / "p"
    path.mkdir()
    (path / "a.csv").write_text("A;1\nbad\n")
    found = text.quarantine(spark, str(path), text.PRODUCTOS_LAYOUT)
    (path / "a.csv").write_text("B;2\nB;3\n")  # what was written is read, not the text again
    assert [r.categoria for r in found.rows.collect()] == ["A"] and [r.value for r in found.rejects.collect()] == ["bad"]
    assert "text" not in found.rows._jdf.queryExecution().executedPlan().toString().lower().split("location")[0]


def test_the_last_line_of_a_key_wins_in_file_order(spark, tmp_path):
    path = tmp_path / "p"
    path.mkdir()
    (path / "a.csv").write_text("Z;1\nA;1\nM;2\nQ;3\n")
    (path / "b.csv").write_text("C;2\nbad\nB;4\nA;4\n")
    found = text.quarantine(spark, str(path), text.PRODUCTOS_LAYOUT).rows
    got = {r.clave: r.categoria for r in text.last_in_file_order(found, "clave", "categoria").collect()}
    assert got == {1: "A", 2: "C", 3: "Q", 4: "A"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # one file read by several tasks
    try:
        (path / "a.csv").write_text("".join(f"C{k};{k % 7}\n" for k in range(200)))
        found = text.quarantine(spark, str(path / "a.csv"), text.PRODUCTOS_LAYOUT).rows
        assert found.select("block").distinct().count() > 3
        got = {r.clave: r.categoria for r in text.last_in_file_order(found, "clave", "categoria").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k % 7: f"C{k}" for k in range(200)}
