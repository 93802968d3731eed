import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with columns that clash with internal names."""

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("c", "n", "h", "id", "ids", "label", "line", "key", "drops", "keeper", "piece", "score", "v", "x"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make


ODD = [(1, None), (2, ""), (3, "   \n\t "), (None, "a text without an id, and some words more"), (4, "same text here"),
       (4, "same text here"), (5, "x" * 70_000), (6, "tail space "), (7, " head"), (8, "é ß 漢字 \U0001f600")]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD, extra=True)
