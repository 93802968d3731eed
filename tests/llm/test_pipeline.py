"""The corpus pipeline, stage by stage."""

from collections import Counter

from conftest import SF_ORACLE
from pyspark.sql import functions as F

from llm.test_documents import plain_components, plain_line_dedup

import __spark_entry__
import corpus_pipeline
from salescp import session
from salescp.llm import pii


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    columns, now = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = now
        now = stage(spark, before, SF_ORACLE).cache()
        kept[name] = (before, now)
        assert now.columns == columns and now.schema == docs.schema
    before, after = kept["quality"]
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    good = before.join(labels.where("quality = 1"), "doc_id").count()
    assert after.join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * good and after.count() < before.count()
    before, after = kept["lines"]
    expect = plain_line_dedup([(r.doc_id, r.text) for r in before.collect()])
    import hashlib
    got = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in after.collect())
    assert got == Counter((i, h) for i, _, _, h in expect.elements())
    assert after.where("char_length(text) != n_chars").count() == before.where("char_length(text) != n_chars").count()
    before, after = kept["near_dups"]
    parts = plain_components([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, _, c in parts if i == c)
    before, after = kept["pii"]
    assert after.count() == before.count()
    assert not any(pii.base_spans(r.text) for r in after.collect())
    rows = corpus_pipeline.STAGES[-1][1](spark, now, SF_ORACLE).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in now.collect()}


def test_stages_with_odd_rows(spark, odd, make_docs, tmp_path):
    spark.createDataFrame([(6, 1, 0), (8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, make_docs([])):
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0 or docs is not None
    first = corpus_pipeline.STAGES[0][1](spark, odd, str(tmp_path))
    assert first.columns == odd.columns and first.where("doc_id is null").count() == 1
    lines = corpus_pipeline.line_stage(spark, odd, str(tmp_path))
    assert lines.where("text is null").count() == 1  # a null text stays null


def test_columns_with_the_names_of_the_operators_travel_unchanged(spark, odd, tmp_path):
    names = ["_score", "_text", "_redacted", "_near_row", "n_lines", "n_dropped", "kept_text", "component_id", "f.g", "_id"]
    docs = odd.select("*", *[F.lit(777 + k).alias(n) for k, n in enumerate(names)])
    spark.createDataFrame([(6, 1, 0), (8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == 777 + k for r in rows for k, n in enumerate(names))


def test_a_document_with_thousands_of_digits_in_an_address(spark, make_docs):
    text = "at 1." + "0" * 5000 + ".2.3 now"
    out = corpus_pipeline.pii_stage(spark, make_docs([(1, text), (2, "mail a@b.org")]), "")
    assert {r.doc_id: r.text for r in out.collect()} == {1: "at [IP] now", 2: "mail [EMAIL]"}


def test_one_row_of_each_near_duplicate_component_stays(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(60))
    near, other = text + " tail", " ".join(f"v{k}" for k in range(60))
    rows = [(9, text), (5, text), (5, text), (5, near), (None, text), (5, other), (6, other + " end"), (None, "alone here"),
            (None, near + " more"), (7, None), (7, None), (None, "")]
    out = corpus_pipeline.near_dup_stage(spark, make_docs(rows, extra=True), "")
    assert out.columns == make_docs(rows, extra=True).columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    first = [t for i, t in got if i == 5 and t in (text, near)]
    assert len(first) == 1
    assert got == Counter([(5, first[0]), (5, other), (None, "alone here"), (7, None), (7, None), (None, "")])


def test_near_dups_keeps_only_the_tables_that_its_result_reads(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(60))
    with session.scratch() as paths:
        out = corpus_pipeline.near_dup_stage(spark, make_docs([(1, text), (2, text + " tail"), (3, "other words")]), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]
    there = [p for p in paths if spark.sparkContext._jvm.java.io.File(p.removeprefix("file:")).exists()]
    assert len(there) == 2  # the rows and what was found of each
    session.drop_materialized(spark, paths)


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
