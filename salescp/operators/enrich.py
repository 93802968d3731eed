"""Validation filters and the two ways of joining sales with their dimensions.

`enrich(..., how="inner")` is the map-side hash join: a sale whose product or
store is missing or filtered out is dropped.  `how="left"` is the reduce-side
join: such a sale is kept with category / department `''`.  For the left form
the dimension filters are applied to the dimension *before* the join; applied
after it they would change the result.

Join strategy (`join_side`): the filtered dimensions are written once, their
rows and bytes counted on the way; one is broadcast only when both prove it small,
otherwise the join is a sort-merge join (the inner form first drops sales that a
bitmap of the dimension's keys rules out, `operators.reduce`), where AQE splits a skewed sales key (one product or
store with a large share of all rows) into several tasks; `session.configure`
sets `forceOptimizeSkewedJoin`, without which an aggregate above the join that
reuses its partitioning would forbid that.

Duplicate dimension keys: the inner form picks one row per key and then
filters it; the left form filters the dimension rows first and picks among
those that pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, BROADCAST_ROW_BYTES, Filters
from ..session import materialize_counted
from .reduce import reduce_facts

SALES_COLUMNS = (
    "clave_local", "clave_producto", "fecha", "cant_vta_original", "cant_vta",
    "precio_unitario", "clave_venta",
)


class DuplicateKeyError(ValueError):
    """A dimension key appears more than once and `strict=True` was asked."""


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when `df` has at most `max_rows` rows; reads at most max_rows + 1."""
    return df.limit(max_rows + 1).count() <= max_rows


def written_sides(dfs, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES):
    """Several (key, value) dimensions computed once, in one written table.

    Returns [(dimension read back, True when it has at most `max_rows` rows and
    `max_bytes` bytes)]; both are counted while they are written.
    """
    names = [df.columns for df in dfs]
    tagged = [df.select(F.lit(i).alias("side"), F.col(k).alias("k"), F.col(v).alias("v")) for i, (df, (k, v)) in enumerate(zip(dfs, names))]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other)
    size = F.octet_length(F.col("v").cast("string"))
    out, seen = materialize_counted(union, {
        **{f"rows{i}": F.count_if(F.col("side") == i) for i in range(len(dfs))},
        **{f"text{i}": F.coalesce(F.sum(F.when(F.col("side") == i, size)), F.lit(0)) for i in range(len(dfs))}})
    small = [seen[f"rows{i}"] <= max_rows and seen[f"rows{i}"] * BROADCAST_ROW_BYTES + seen[f"text{i}"] <= max_bytes
             for i in range(len(dfs))]
    return [(out.where(F.col("side") == i).select(F.col("k").alias(k), F.col("v").alias(v)), small[i])
            for i, (k, v) in enumerate(names)]


def join_side(df: DataFrame, strategy: str = "auto", max_rows: int = BROADCAST_MAX_ROWS,
              small: bool | None = None) -> DataFrame:
    """Wrap the small side of a join with the hint its checked size allows.

    checked (dimensions): broadcast the side when its row count (`small`, or a
    bounded `limit(max_rows + 1)` job) is within `max_rows`, else a sort-merge
    join, whose skewed partitions AQE splits.  The hint also keeps the planner from
    building the hash table on the fact side when its estimate is small.
    auto: no hint; Catalyst broadcasts only under
    `spark.sql.autoBroadcastJoinThreshold` and AQE re-decides with measured sizes.
    broadcast: as checked, but an oversize side raises.
    shuffle: sort-merge join hint (the reduce-side join of the original).
    """
    if strategy == "auto":
        return df
    if strategy == "shuffle":
        return df.hint("shuffle_merge")
    if strategy not in ("checked", "broadcast"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    if small is None:
        small = bounded_rows(df, max_rows)
    if small:
        return F.broadcast(df)
    if strategy == "broadcast":
        raise ValueError(f"join side has more than {max_rows} rows; refusing to broadcast it")
    return df.hint("shuffle_merge")


def dedupe_dimension(dim: DataFrame, key: str = "clave", value: str | None = None,
                     strict: bool = False) -> DataFrame:
    """One row per dimension key; the largest value wins so the choice is repeatable.

    `strict=True` raises `DuplicateKeyError` when a key repeats.
    """
    value = value or [c for c in dim.columns if c != key][0]
    dim = dim.filter(F.col(key).isNotNull())
    if strict:
        dup = dim.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"duplicate dimension key {dup[0][key]!r}")
    return dim.groupBy(key).agg(F.max(value).alias(value))


def valid_sales(ventas: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """sales filter, quantity >= min and min <= price <= max, bounds inclusive.

    NaN never passes (Spark orders NaN above every number, so it is excluded
    explicitly).
    """
    qty = F.col("cant_vta_original")
    price = F.col("precio_unitario")
    return ventas.filter(
        (qty >= F.lit(filters.quantity_min)) & ~F.isnan(qty)
        & (price >= F.lit(filters.price_min)) & (price <= F.lit(filters.price_max)) & ~F.isnan(price)
    )


def product_filter(productos: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """category present and not the excluded one."""
    cond = F.col("categoria").isNotNull()
    if filters.excluded_category is not None:
        cond = cond & (F.col("categoria") != F.lit(filters.excluded_category))
    return productos.filter(cond)


def store_filter(locales: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """department in the chosen list (NULL never matches)."""
    return locales.filter(F.col("departamento").isin(*filters.departments))


def enrich(ventas: DataFrame, productos: DataFrame, locales: DataFrame, how: str = "inner",
           filters: Filters = Filters(), join_strategy: str = "checked",
           broadcast_max_rows: int = BROADCAST_MAX_ROWS, strict: bool = False,
           broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """J1 (how="inner") / J2+J3 (how="left"): sales with `categoria` and `departamento`, filtered.

    Returns the sales columns plus `categoria`, `departamento`.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if how == "left":  # the filter comes first, and reaches the scan
        prod = dedupe_dimension(product_filter(productos, filters), "clave", "categoria", strict)
        stores = dedupe_dimension(store_filter(locales, filters), "clave", "departamento", strict)
    else:
        prod = product_filter(dedupe_dimension(productos, "clave", "categoria", strict), filters)
        stores = store_filter(dedupe_dimension(locales, "clave", "departamento", strict), filters)
    prod = prod.select(F.col("clave").alias("clave_producto"), "categoria")
    stores = stores.select(F.col("clave").alias("clave_local"), "departamento")
    sales = valid_sales(ventas, filters)
    small = [None, None]
    if join_strategy in ("checked", "broadcast"):
        (prod, small[0]), (stores, small[1]) = written_sides(
            [prod, stores], broadcast_max_rows, broadcast_max_bytes)
    if how == "inner":  # what a shuffle would only carry to be dropped goes before it
        for side, key, fits in ((prod, "clave_producto", small[0]), (stores, "clave_local", small[1])):
            if fits is False:
                sales = reduce_facts(sales, side, key)
    out = (
        sales.join(join_side(prod, join_strategy, broadcast_max_rows, small[0]), "clave_producto", how)
        .join(join_side(stores, join_strategy, broadcast_max_rows, small[1]), "clave_local", how)
    )
    if how == "left":
        out = out.withColumn("categoria", F.coalesce(F.col("categoria"), F.lit(""))).withColumn(
            "departamento", F.coalesce(F.col("departamento"), F.lit(""))
        )
    cols = [c for c in SALES_COLUMNS if c in ventas.columns]
    return out.select(*cols, "categoria", "departamento")
