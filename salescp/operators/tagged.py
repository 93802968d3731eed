"""Left joins of sales with a dimension as a tagged union: one shuffle, no join.

Dimension rows (tag 0) and sales (tag 1) go through one exchange on the key; in key order, the dimension's
rows first, a window carries the dimension's value on to the sales.  Of several rows of a key the largest
value is carried, as everywhere; a sale whose key has none gets ''.

A product with a third of all sales is dealt to `deals` parts by a hash of the sale, and every dimension row
goes to each part, so the exchange carries `deals` times the dimension (small beside the sales) and a task
holds a `deals`-th of the hottest key.  The window's frame ends at the current row: rows stream through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import Filters
from .enrich import SALES_COLUMNS, product_filter, store_filter, valid_sales


def tagged_left(sales: DataFrame, dim: DataFrame, key: str, value: str, deals: int = 16, dim_key: str = "clave") -> DataFrame:
    """`sales` with `value` of the dimension row of its `key`, '' without one."""
    names = sales.columns
    part = F.pmod(F.xxhash64(*names), F.lit(deals)).cast("int")
    kind = sales.schema[key].dataType
    dims = dim.where(F.col(dim_key).isNotNull() & F.col(value).isNotNull()).select(
        F.col(dim_key).cast(kind).alias(key), F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("_part"),
        F.lit(0).alias("_tag"), F.col(value).alias("_value"))
    both = dims.unionByName(sales.select("*", part.alias("_part"), F.lit(1).alias("_tag")), allowMissingColumns=True)
    carried = Window.partitionBy(key, "_part").orderBy("_tag", "_value").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_carried", F.last("_value", ignorenulls=True).over(carried)).where("_tag = 1")
    return out.select(*names, F.coalesce("_carried", F.lit("")).alias(value))


def enrich_tagged(ventas: DataFrame, productos: DataFrame, locales: DataFrame, filters: Filters = Filters(),
                  deals: int = 16) -> DataFrame:
    """The rows of `enrich(how="left")`, each dimension by one exchange."""
    out = tagged_left(valid_sales(ventas, filters), product_filter(productos, filters), "clave_producto", "categoria", deals)
    out = tagged_left(out, store_filter(locales, filters), "clave_local", "departamento", deals)
    return out.select(*[c for c in SALES_COLUMNS if c in ventas.columns], "categoria", "departamento")
