"""The native `;`-separated text tables: sales (ventas), products, stores.

No header, no quoting, columns by position.  A line is kept only if it has
enough fields and every numeric field parses (`try_cast`, never a failing
cast); otherwise it is rejected and counted.  This holds for the dimension
tables too: a bad line (for example a header) drops only that line.  The sale
date stays text at the source; a bad date only drops the point from the price
series later, the sale still counts in the aggregates.

Counts of read and rejected lines come back through a Spark `Observation`,
filled in by whatever action runs the plan; with `strict=True` that action fails
on the first bad line instead.

`quarantine` keeps the rejected lines too: one scan writes every line, typed or
with its reason, and where it stood; rows and rejects are read from what was written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import FIELD_SEPARATOR
from ..session import materialize

# --- fixed values: column layouts of the native tables (position order) -----
VENTAS_LAYOUT = (
    ("clave_local", "bigint"),
    ("clave_producto", "bigint"),
    ("fecha", "string"),
    ("cant_vta_original", "float"),
    ("cant_vta", "float"),
    ("precio_unitario", "float"),
    ("clave_venta", "bigint"),
)
PRODUCTOS_LAYOUT = (("categoria", "string"), ("clave", "bigint"))
LOCALES_LAYOUT = (("departamento", "string"), ("clave", "bigint"))
# ---------------------------------------------------------------------------


BAD_ROW = "BAD_ROW"  # begins the message of the error that `strict=True` raises


@dataclass
class Parsed:
    rows: DataFrame
    observation: Observation

    def counts(self) -> dict:
        """{'lines': n, 'rejected': m}; valid after an action ran on `rows`."""
        return dict(self.observation.get)


def parse_lines(lines: DataFrame, layout, sep: str = FIELD_SEPARATOR, name: str = "table",
                strict: bool = False) -> Parsed:
    """Split a one-column (`value`) text DataFrame into typed columns, rejecting bad lines."""
    parts = F.split(F.col("value"), _regex_literal(sep), -1)
    cols, checks = [], [F.size(parts) >= len(layout)]
    for pos, (col, dtype) in enumerate(layout):
        raw = F.get(parts, pos)
        if dtype == "string":
            cols.append(raw.alias(col))
        else:
            val = raw.try_cast(dtype)
            cols.append(val.alias(col))
            checks.append(val.isNotNull())
    ok = checks[0]
    for c in checks[1:]:
        ok = ok & c
    typed = lines.select(*cols, F.coalesce(ok, F.lit(False)).alias("_ok"))
    if strict:  # in the one scan: the first bad line ends the job that reads the rows
        message = f"{BAD_ROW}: {name}: a line does not match the {len(layout)}-field layout"
        typed = typed.withColumn("_ok", F.when(F.col("_ok"), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
    obs = Observation(f"{name}_lines")
    observed = typed.observe(obs, F.count(F.lit(1)).alias("lines"),
                             F.sum(F.when(F.col("_ok"), 0).otherwise(1)).alias("rejected"))
    return Parsed(observed.filter(F.col("_ok")).drop("_ok"), obs)


@dataclass
class Quarantined:
    """Both outcomes of one scan; file, block and line tell where a line stood."""

    rows: DataFrame  # the layout's columns, file, block, line
    rejects: DataFrame  # reason, value, file, block, line


def quarantine(spark: SparkSession, path: str, layout, sep: str = FIELD_SEPARATOR) -> Quarantined:
    """S4/S5 with the rejected lines: the reason is 'short line' or the first field that does not parse.

    file: the file's path; block: the byte at which the part of the file that one task read begins; line: the
    line's number in that block, from 0.  Lines of one file stand in the order (block, line).
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_seq"))
    parts = F.split(F.col("value"), _regex_literal(sep), -1)
    reason, cols = F.when(F.size(parts) < len(layout), F.lit("short line")), []
    for pos, (col, dtype) in enumerate(layout):
        raw = F.get(parts, pos)
        val = raw if dtype == "string" else raw.try_cast(dtype)
        cols.append(val.alias(col))
        if dtype != "string":
            reason = reason.when(val.isNull(), F.lit(f"bad {col}"))
    typed = materialize(lines.select(*cols, reason.alias("_reason"), "file", "block", "_seq",
                                     F.when(reason.isNotNull(), F.col("value")).alias("_value")))
    # a block is read by one task in order, so its lines have neighbouring numbers
    first = typed.groupBy("file", "block").agg(F.min("_seq").alias("_first"))
    placed = typed.join(first, ["file", "block"]).withColumn("line", F.col("_seq") - F.col("_first"))
    return Quarantined(placed.where("_reason is null").select(*(c for c, _ in layout), "file", "block", "line"),
                       placed.where("_reason is not null").select(
                           F.col("_reason").alias("reason"), F.col("_value").alias("value"), "file", "block", "line"))


def last_in_file_order(rows: DataFrame, key: str, value: str) -> DataFrame:
    """S6 by arrival: one row per key, the value of its last line (by file, block, line) among `Quarantined.rows`."""
    at = F.struct("file", "block", "line")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, at).alias(value))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in sep)


def read_table(spark: SparkSession, path: str, layout, sep: str = FIELD_SEPARATOR, name: str = "table",
               strict: bool = False) -> Parsed:
    return parse_lines(spark.read.text(path), layout, sep, name, strict)


def read_ventas(spark: SparkSession, path: str, strict: bool = False) -> Parsed:
    return read_table(spark, path, VENTAS_LAYOUT, name="ventas", strict=strict)


def read_productos(spark: SparkSession, path: str, strict: bool = False) -> Parsed:
    return read_table(spark, path, PRODUCTOS_LAYOUT, name="productos", strict=strict)


def read_locales(spark: SparkSession, path: str, strict: bool = False) -> Parsed:
    return read_table(spark, path, LOCALES_LAYOUT, name="locales", strict=strict)
