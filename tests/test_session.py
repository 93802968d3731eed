import os
import subprocess
import sys
import types

import pytest
from conftest import ROOT

from salescp import session


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    fake = types.SimpleNamespace(sparkContext=Context(), conf=types.SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake)


def test_the_session_keeps_its_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Montevideo")
    try:
        session.configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Montevideo"
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_clean_up_covers_one_block_only(spark):
    with session.scratch() as first:
        a = session.materialize(spark.range(5))
    with session.scratch() as second:
        b = session.materialize(spark.range(7))
    assert session.drop_materialized(spark, first) == 1
    assert b.count() == 7  # the other block's table is still there
    with pytest.raises(Exception):
        a.count()
    assert session.drop_materialized(spark, second) == 1


def test_a_local_session_without_a_setting_makes_its_own_folder(spark, monkeypatch, tmp_path):
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from salescp import session\n"
            "s = session.local_session(2, 2)\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None, 'the setting is there'\n"
            "df = session.materialize(s.range(9))\n"
            "assert df.count() == 9 and session.checkpoint_dir(s) == session.checkpoint_dir(s)\n"
            "print('made', session.checkpoint_dir(s))\n")
    conf = tmp_path / "conf"  # an empty configuration folder: nothing names a checkpoint folder
    conf.mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(conf), "TMPDIR": str(tmp_path)}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    run = subprocess.run([sys.executable, "-c", code, ROOT], env=env, capture_output=True, text=True, timeout=180)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "made" in run.stdout


def test_a_block_leaves_no_table_behind(spark, tmp_path):
    import os

    from conftest import SF_SMALL
    from salescp.plans.queries import QUERIES

    def held():
        root = session.checkpoint_dir(spark).removeprefix("file:")
        return {p for p in os.listdir(root) if p.startswith("salescp-")}

    before = held()
    with session.scratch() as paths:
        for name in ("edpelt", "divide_pelt", "edpelt_by_blocks", "enriched_inner", "conclusion_file", "text_last_duplicate", "edpelt_radix_ranks"):
            QUERIES[name](spark, SF_SMALL).collect()
    assert len(held() - before) == len(paths) > 10
    assert session.drop_materialized(spark, paths) > 10 and held() == before


def test_rounds_hold_one_round_of_tables(spark):
    import os

    root = session.checkpoint_dir(spark).removeprefix("file:")
    with session.scratch() as paths:
        rounds, current, most = session.Rounds(spark), spark.range(10), 0
        before = len(os.listdir(root))
        for _ in range(4):
            with rounds.next():
                current = session.materialize(current.selectExpr("id + 1 as id"))
            most = max(most, len(os.listdir(root)) - before)
        rounds.done()
        assert most == 1 and [r.id for r in current.orderBy("id").collect()] == list(range(4, 14))
    assert len(paths) == 1 and session.drop_materialized(spark, paths) == 1


def test_two_jobs_side_by_side(spark):
    a, b = session.side_by_side(lambda: session.materialize(spark.range(5)).count(), lambda: spark.range(7).count())
    assert (a, b) == (5, 7)
    with pytest.raises(Exception, match="no such"):
        session.side_by_side(lambda: spark.range(1).count(), lambda: (_ for _ in ()).throw(ValueError("no such")))
