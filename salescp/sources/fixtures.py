"""The driver's TPC-H-like tables seen as the sales star schema.

    ventas    <- lineitem   (store = supplier, product = part)
    productos <- part       (category = brand or type)
    locales   <- supplier x nation x region (department = region name)

Column pruning and filters reach the parquet scans: only the columns named
here are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATEGORY_COLUMNS = {"brand": "p_brand", "type": "p_type"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ventas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales fact table with the seven columns of the native text layout."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("float")
    return li.select(
        F.col("l_suppkey").alias("clave_local"),
        F.col("l_partkey").alias("clave_producto"),
        F.col("l_shipdate").cast("date").alias("fecha"),
        qty.alias("cant_vta_original"),
        qty.alias("cant_vta"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).cast("float").alias("precio_unitario"),
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("clave_venta"),
    )


def productos(spark: SparkSession, sf_dir: str, category: str = "brand") -> DataFrame:
    """Product dimension: (categoria, clave)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col(CATEGORY_COLUMNS[category]).alias("categoria"),
        F.col("p_partkey").alias("clave"),
    )


def locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension: (departamento, clave) through nation and region.

    No hint: Catalyst sees the exact file sizes of nation and region and
    broadcasts them only because they are under the broadcast threshold.
    """
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nat.join(reg, nat.n_regionkey == reg.r_regionkey)
    return sup.join(geo, sup.s_nationkey == geo.n_nationkey).select(
        F.col("r_name").alias("departamento"),
        F.col("s_suppkey").alias("clave"),
    )


def star(spark: SparkSession, sf_dir: str, category: str = "brand"):
    """(ventas, productos, locales) for one fixture directory."""
    return ventas(spark, sf_dir), productos(spark, sf_dir, category), locales(spark, sf_dir)
