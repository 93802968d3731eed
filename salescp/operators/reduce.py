"""Reduction of a fact table before a shuffle join, by a bitmap of the other side's keys.

The keys are hashed into a bitmap of `bits` bits (a Bloom filter with one hash function), cut in
rows of 32,768 bits.  The fact table meets the bitmap in a broadcast semi-join on the row's number and
keeps what has its bit set: every row with a partner, and of the others the share of bits that are set.
The join that follows is exact, so the result does not change; only rows that it would drop are spared
its shuffle.  The broadcast side has `bits` / 32,768 rows of 8 KB whatever the tables' sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_BITS = 32_768
FILTER_BITS = 1 << 26  # 2,048 rows, 16 MB; up to 8 million keys leave 12 % of the rows without a partner


def _bit(key: str, bits: int):
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(bits))


def key_bitmap(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(bit_row, words): the set bits of each row as 1,024 numbers of 32 bits."""
    at = keys.where(F.col(key).isNotNull()).select(_bit(key, bits).alias("at"))
    rows = at.groupBy(F.floor(F.col("at") / ROW_BITS).alias("bit_row")).agg(
        F.bitmap_construct_agg(F.col("at") % ROW_BITS).alias("map"))
    word = lambda i: F.conv(F.hex(F.substring("map", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return rows.select("bit_row", F.transform(F.sequence(F.lit(0), F.lit(ROW_BITS // 32 - 1)), word).alias("words"))


def may_join(facts: DataFrame, key: str, bitmap: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of `facts` whose key's bit is set; others have no partner."""
    at = _bit(key, bits) % ROW_BITS
    # bytes of a word stand from the highest down, the bits of a byte from the lowest up
    shift = (F.lit(3) - F.floor(at / 8) % 4) * 8 + at % 8
    word = F.element_at(F.col("words"), (F.floor(at / 32) + 1).cast("int"))
    is_set = F.call_function("getbit", word, shift.cast("int")) == 1
    return facts.join(F.broadcast(bitmap), (F.floor(_bit(key, bits) / ROW_BITS) == F.col("bit_row")) & is_set, "left_semi")


def reducible(facts: DataFrame, keys: DataFrame, key: str) -> bool:
    """Both keys are whole numbers, so that equal keys have equal hashes as bigint."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return isinstance(facts.schema[key].dataType, whole) and isinstance(keys.schema[key].dataType, whole)


def reduce_facts(facts: DataFrame, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """`facts` without rows whose `key` cannot be among `keys` (unchanged if the keys are not whole numbers)."""
    return may_join(facts, key, key_bitmap(keys, key, bits), bits) if reducible(facts, keys, key) else facts
