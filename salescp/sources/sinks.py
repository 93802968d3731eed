"""Sinks: parquet (main), `key<TAB>value` text, and a single-file form for small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import DATE_FORMAT


def _as_text(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.DateType):
        return F.date_format(col, DATE_FORMAT)
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: x.cast("string")), ", ")
    return col.cast("string")


def text_lines(df: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str], key_sep: str = "\t",
               sep: str = "\t", null_text: str = "NULL") -> DataFrame:
    """One `value` column: key fields joined by `key_sep`, then `sep`, then value fields."""
    key = F.concat_ws(key_sep, *[F.coalesce(_as_text(df, c), F.lit(null_text)) for c in key_cols])
    val = F.concat_ws(key_sep, *[F.coalesce(_as_text(df, c), F.lit(null_text)) for c in value_cols])
    return df.select(F.concat(key, F.lit(sep), val).alias("value"))


def write_text(df: DataFrame, path: str, key_cols: Sequence[str], value_cols: Sequence[str],
               sep: str = "\t", mode: str = "overwrite", single_file: bool = False) -> None:
    """Text sink; `single_file=True` only for small results such as roll-ups."""
    out = text_lines(df, key_cols, value_cols, sep=sep)
    if single_file:
        out = out.repartition(1)  # a shuffle: what is below stays parallel
    out.write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
