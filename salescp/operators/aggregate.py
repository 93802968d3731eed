"""Grouped aggregates over enriched sales and the two composed summary queries.

All sums and means are in double precision.  Spark aggregates partially on
the map side before the shuffle, so a key holding a large share of the rows
reaches the reducer as one partial row per input partition.  With `exact=True`
a sum or mean is the same bit for bit whatever the partitioning
(`functions.exact`); plain double sums depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import year_text
from ..functions.exact import exact_sums
from ..params import Filters
from .enrich import enrich


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def average_by_subkey(df: DataFrame, keys, x: str, y: str, name: str = "promedio", exact: bool = False) -> DataFrame:
    """A1: mean of y per (key, x)."""
    if exact:
        out = exact_sums(df, [*_keys(keys), x], F.col(y).cast("double"), "_sum", rows="_rows")
        return out.select(*_keys(keys), x, F.try_divide("_sum", "_rows").alias(name))
    return df.groupBy(*_keys(keys), x).agg(F.avg(F.col(y).cast("double")).alias(name))


def count_by_subkey(df: DataFrame, keys, x: str, name: str = "cantidad") -> DataFrame:
    """A2: rows per (key, x)."""
    return df.groupBy(*_keys(keys), x).agg(F.count(F.lit(1)).alias(name))


def sum_by_subkey(df: DataFrame, keys, x: str, y: str, name: str = "suma", exact: bool = False) -> DataFrame:
    """A3: sum of y per (key, x)."""
    if exact:
        return exact_sums(df, [*_keys(keys), x], F.col(y).cast("double"), name)
    return df.groupBy(*_keys(keys), x).agg(F.sum(F.col(y).cast("double")).alias(name))


def sum_by_key(df: DataFrame, keys, y: str, name: str = "suma", exact: bool = False) -> DataFrame:
    """A4: sum of y per key."""
    if exact:
        return exact_sums(df, _keys(keys), F.col(y).cast("double"), name)
    return df.groupBy(*_keys(keys)).agg(F.sum(F.col(y).cast("double")).alias(name))


def sum_values(df: DataFrame, keys, v: str, name: str = "suma", exact: bool = False) -> DataFrame:
    """A5: sum of a value that may be text; non-numeric values are ignored, empty sum is 0."""
    val = F.col(v)
    if dict(df.dtypes)[v] == "string":
        val = F.trim(val).try_cast("double")
    if exact:
        return exact_sums(df, _keys(keys), val.cast("double"), name).withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))
    return df.groupBy(*_keys(keys)).agg(F.coalesce(F.sum(val.cast("double")), F.lit(0.0)).alias(name))


def max_by_key(df: DataFrame, keys, y: str, name: str = "maximo") -> DataFrame:
    """Largest y per key (a true maximum, also for all-negative groups)."""
    return df.groupBy(*_keys(keys)).agg(F.max(F.col(y).cast("double")).alias(name))


def with_year(df: DataFrame, date_col: str = "fecha", name: str = "year") -> DataFrame:
    return df.withColumn(name, year_text(df, date_col))


def quantity_by_cat_dep(ventas: DataFrame, productos: DataFrame, locales: DataFrame,
                        filters: Filters = Filters(), join_strategy: str = "checked", exact: bool = False) -> DataFrame:
    """Q1: total original quantity per (category, department) over the left joins.

    Sales whose product or store is missing or filtered out stay, under `''`.
    """
    enriched = enrich(ventas, productos, locales, how="left", filters=filters, join_strategy=join_strategy)
    return sum_values(enriched, ["categoria", "departamento"], "cant_vta_original", "cantidad", exact)


def daily_price_by_cat_dep_year(ventas: DataFrame, productos: DataFrame, locales: DataFrame,
                                filters: Filters = Filters(), join_strategy: str = "checked", exact: bool = False) -> DataFrame:
    """Q2: sum of unit price per day, keyed by (category, department, year), inner joins."""
    enriched = with_year(enrich(ventas, productos, locales, how="inner", filters=filters,
                                join_strategy=join_strategy))
    return sum_by_subkey(enriched, ["categoria", "departamento", "year"], "fecha", "precio_unitario",
                         "suma_precio", exact)
