"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, cap_filters, filter_audit, jaccard_join, language_id, line_dedup, multi_index, packing, pii,
               quality, sharding, token_counts)
from .common import table

BYTE_BPE = "byte_bpe_50k.tiktoken"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE_JSON = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product to every vector whose id is divisible by 20."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text of documents; ids and decoded bytes as digests."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                             public_tokenizers.PATTERN, finish=bpe.digest_columns,
                             schema="n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; learned outside the fold crc32(doc_id) mod 5 = 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs, public_tokenizers.path(MULTI_BPE))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that 5 documents share stay in the last one only."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, as word-BPE ids closed by id 1, in sequences of 4096."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text; learned from positives outside the fold crc32(doc_id) mod 3 = 1."""
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and digest of the pattern spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs), pii.digest, pii.DIGEST)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over shingles of five words at a Jaccard similarity of 0.8."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


#: The edits of op9, from the document's own columns: its source is put in front, up to 200
#: characters from a place in the first half go, a word is put in at a place in the second half,
#: and the tail is cut by up to 40 characters.
OP9_EDITS = """array(
  named_struct('start', 0L, 'removed', 0L, 'inserted', concat(coalesce(source, ''), ' ')),
  named_struct('start', cast(pmod(crc32(cast(doc_id as string)), 1 + n div 2) as bigint),
               'removed', cast(pmod(crc32(cast(doc_id as string)), 201) as bigint), 'inserted', ''),
  named_struct('start', cast(n div 2 + pmod(xxhash64(doc_id), 1 + n div 2) as bigint), 'removed', 0L,
               'inserted', concat(' ', coalesce(lang, ''), ' edited ', cast(doc_id as string), ',')),
  named_struct('start', cast(greatest(0, n - pmod(crc32(cast(doc_id as string)), 41)) as bigint), 'removed', 41L,
               'inserted', '.'))"""


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after four edits made from its own columns."""
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
            .withColumn("n", F.coalesce(F.char_length("text"), F.lit(0)))
            .select("doc_id", "text", F.expr(OP9_EDITS).alias("edits")))
    return token_counts.edited_counts(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op10_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label, cosine 0.93 or more."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens of a byte-level and a piece vocabulary, aligned; id pairs counted over the corpus."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE_JSON),
                           public_tokenizers.path(PIECE_BPE), pattern=public_tokenizers.PATTERN)[0]


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five document filters in all 120 orders, by source."""
    return filter_audit.audit(filter_audit.combinations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of even row counts, equal texts together as far as that allows."""
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), 16).drop("k1", "k2")


QUERIES = {f.__name__: f for f in (
    op1_multi_index, op2_byte_bpe, op3_language_id, op4_line_dedup, op5_best_fit_packing, op6_quality, op7_pii,
    op8_jaccard_join, op9_edit_counts, op10_cap_filters, op11_alignment, op12_filter_audit, op13_balanced_shards)}
