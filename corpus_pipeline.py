"""A corpus in five stages, each an operator of `salescp.llm` whose decisions take effect.

quality   documents that the classifier rejects go (score under 0.5)
lines     lines that many documents share go, but in the last document
near_dups one row of each near-duplicate component stays: the smallest id's
pii       personal data is replaced by its kind in brackets
packing   the documents become token sequences (one row per piece)

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes
each as Parquet in the shared checkpoint folder and reads it as the next one's
documents.  All but the last return the columns of documents; n_chars follows a
changed text; extra columns of any name travel through unchanged.

Defined results: rows with a null id pass quality and lines, and are compared like
any other in near_dups, where a row with an id goes before them; a null text is
scored, kept or rejected like an empty one and stays null; of rows that repeat an
id each is judged by its own text, and near_dups keeps one of equal or nearly equal
rows, under one id or several (one id: the smallest text hash); empty tables stay
empty.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescp.llm import jaccard_join, line_dedup, packing, pii, quality
from salescp.llm.common import table
from salescp.llm.queries import WORD_BPE
from salescp.session import drop_materialized, materialize, scratch, shuffles_go


#: Columns of documents that a stage may read or change; all others only travel through it.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage):
    """The stage over the caller's own columns, with every other one under a name that no operator uses."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = docs.toDF(*(c if c in OWN else f"_travels_{k}" for k, c in enumerate(docs.columns)))
        return stage(spark, inner, sf_dir).toDF(*docs.columns)

    return run_stage


def _with_text(docs: DataFrame, new: str, like: DataFrame) -> DataFrame:
    """The columns of `like`, with the text from column `new` and n_chars to match (null texts stay)."""
    text = F.when(F.col("text").isNotNull(), F.col(new))
    columns = []
    for c in like.columns:
        if c == "text":
            columns.append(text.alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("text").isNotNull() & ~F.col(new).eqNullSafe(F.col("text")),
                                  F.char_length(F.col(new)).cast(like.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return docs.select(*columns)


@keeps_columns
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the trusted positives of `labels` outside the held-out fold; keeps what scores 0.5 or more."""
    fold = quality.id_bucket("doc_id", 3)
    net = quality.fit(docs.where(fold != 1), table(spark, sf_dir, "labels").where(fold != 1))
    return quality.score(docs, net).where((F.col("_score") >= 0.5) | F.col("doc_id").isNull()).drop("_score")


@keeps_columns
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    return _with_text(out, "kept_text", docs)


@keeps_columns
def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, the one of smallest id; what links with nothing stays."""
    rows = materialize(docs.withColumn("_near_row", F.monotonically_increasing_id()))  # written, so a row keeps its number
    with scratch() as used:
        found = (jaccard_join.near_duplicates(rows.select("_near_row", "text"), id_col="_near_row")
                 .join(rows.select("_near_row", "doc_id"), "_near_row"))
    with shuffles_go(spark):
        found = materialize(found.select("_near_row", "component_id", "doc_id", "text_hash"))
    drop_materialized(spark, used)
    stays = found.groupBy("component_id").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "text_hash", "_near_row")).alias("least")).select("least._near_row")
    gone = found.select("_near_row").join(stays, "_near_row", "left_anti")
    return rows.join(gone, "_near_row", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


@keeps_columns
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tagger = pii.fit(docs)
    out = pii.find(docs, tagger, pii.redact, "_redacted string", keep=docs.columns)
    return _with_text(out, "_redacted", docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # smaller caches than alone: the executors' Java heaps have grown in the stages before
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE), caches=(300_000, 100_000))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_dups", near_dup_stage), ("pii", pii_stage),
          ("packing", packing_stage)]

#: Not SQL: a trained classifier, a trained tagger and a tokenizer; tests/llm/test_pipeline.py checks
#: each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
