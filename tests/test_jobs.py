import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from salescp.plans import jobs
from salescp.params import Filters
from salescp.sources import fixtures


def _export(spark, tmp_path):
    """Write the sf0.001 fixture star schema as native `;` text files."""
    v, p, l = fixtures.star(spark, SF_SMALL, "type")
    paths = {}
    for name, df in (("ventas", v), ("productos", p), ("locales", l)):
        out = str(tmp_path / name)
        df.select(F.concat_ws(";", *[F.col(c).cast("string") for c in df.columns]).alias("value")) \
          .write.mode("overwrite").text(out)
        paths[name] = out
    return paths


def test_jobs_end_to_end(spark, tmp_path):
    paths = _export(spark, tmp_path)
    f = Filters(("AFRICA", "AMERICA"), "Brand#10")
    for job in ("reduce-join-sum", "hash-join-sum", "pelt", "regression", "divide"):
        out = str(tmp_path / f"out-{job}")
        counts = jobs.run(spark, job, paths["ventas"], paths["productos"], paths["locales"], out, f,
                          key_cols=("categoria", "year", "clave_local"))
        assert counts["rejected"] == 0
        if job in ("pelt", "regression", "divide"):
            lines = spark.read.text(f"{out}/conclusions").collect()
            files = [x for x in os.listdir(f"{out}/conclusions") if x.startswith("part-")]
            assert len(files) == 1
            assert all("\t{" in r.value for r in lines)
        else:
            assert spark.read.text(out).count() > 0


def test_parquet_outputs(spark, tmp_path):
    paths = _export(spark, tmp_path)
    out = str(tmp_path / "out-parquet")
    jobs.run(spark, "pelt", paths["ventas"], paths["productos"], paths["locales"], out,
             Filters(("AFRICA", "AMERICA"), "Brand#10"), key_cols=("categoria", "year", "clave_local"), fmt="parquet")
    det = spark.read.parquet(f"{out}/detections")
    con = spark.read.parquet(f"{out}/conclusions")
    assert det.columns == ["categoria", "year", "clave_local", "change_point", "status"]
    assert con.columns == ["categoria", "year", "histogram"]
    assert det.count() > 0 and con.count() > 0
