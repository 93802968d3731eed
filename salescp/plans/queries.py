"""The named queries: each takes (spark, sf_dir) and returns a DataFrame.

They run over the whole fixture tables; the series keys follow the survey
of which keys carry change points on this data:
    (brand, year)                for ED-PELT and divide-PELT,
    (type, year, supplier)       for segmented regression,
    (type, year)                 for the plain aggregates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import exact_sums
from ..operators import aggregate as agg
from ..operators import conclude, divide
from ..operators.detect import detect
from ..operators.edpelt import partial_sums, positions, threshold_histogram, thresholds, value_counts
from ..operators.edpelt import edpelt, edpelt_within
from ..operators.edpelt_blocks import edpelt_blocks
from ..operators.enrich import enrich
from ..operators.regression import segmented_regression
from ..operators.series import price_series
from ..operators.tagged import enrich_tagged
from ..params import Filters
from ..session import checkpoint_dir, materialize, note_written
from ..sources import fixtures, sinks, text
from . import jobs

FIXTURE = Filters.fixture()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removesuffix("_q")] = fn
    return fn


def enriched(spark: SparkSession, sf_dir: str, category: str = "brand", how: str = "inner") -> DataFrame:
    v, p, l = fixtures.star(spark, sf_dir, category)
    return agg.with_year(enrich(v, p, l, how=how, filters=FIXTURE))


@query
def daily_price_by_cat_dep_year(spark, sf_dir):
    v, p, l = fixtures.star(spark, sf_dir, "brand")
    out = agg.daily_price_by_cat_dep_year(v, p, l, FIXTURE)
    return out.withColumn("suma_precio", F.round("suma_precio", 2))


@query
def quantity_by_cat_dep(spark, sf_dir):
    v, p, l = fixtures.star(spark, sf_dir, "brand")
    return agg.quantity_by_cat_dep(v, p, l, FIXTURE)  # whole numbers: exact in any order


_ENRICHED_COLS = ("clave_local", "clave_producto", "fecha", "cant_vta_original", "precio_unitario",
                  "clave_venta", "categoria", "departamento")


@query
def enriched_inner(spark, sf_dir):
    return enriched(spark, sf_dir, "brand", "inner").select(*_ENRICHED_COLS)


@query
def enriched_left(spark, sf_dir):
    return enriched(spark, sf_dir, "brand", "left").select(*_ENRICHED_COLS)


@query
def enriched_inner_reduced(spark, sf_dir):
    """The inner join with dimensions taken as too large to broadcast: sales meet bitmaps of their keys, then sort-merge joins."""
    v, p, l = fixtures.star(spark, sf_dir, "brand")
    return enrich(v, p, l, how="inner", filters=FIXTURE, broadcast_max_rows=0).select(*_ENRICHED_COLS)


@query
def enriched_left_tagged(spark, sf_dir):
    """The left joins as tagged unions, with duplicate dimension keys: one exchange for each dimension, no join."""
    return enrich_tagged(*doubled_star(spark, sf_dir), filters=FIXTURE).select(*_ENRICHED_COLS)


@query
def avg_by_day(spark, sf_dir):
    return agg.average_by_subkey(enriched(spark, sf_dir, "type"), ["categoria", "year"], "fecha",
                                 "precio_unitario", exact=True)


@query
def count_by_day(spark, sf_dir):
    return agg.count_by_subkey(enriched(spark, sf_dir, "type"), ["categoria", "year"], "fecha")


@query
def sum_by_key(spark, sf_dir):
    return agg.sum_by_key(enriched(spark, sf_dir, "type"), ["categoria", "year"], "precio_unitario", exact=True)


@query
def max_by_key(spark, sf_dir):
    return agg.max_by_key(enriched(spark, sf_dir, "type"), ["categoria", "year"], "precio_unitario")


REGRESSION_KEYS = ["categoria", "year", "clave_local"]


def regression_result(spark, sf_dir):
    series = price_series(enriched(spark, sf_dir, "type"), REGRESSION_KEYS)
    return segmented_regression(series, REGRESSION_KEYS)


@query
def segmented_regression_q(spark, sf_dir):
    return regression_result(spark, sf_dir)


@query
def regression_by_blocks(spark, sf_dir):
    """The same regression by a two-level scan over blocks of 64 days, from order-free per-date sums."""
    series = price_series(enriched(spark, sf_dir, "type"), REGRESSION_KEYS)
    return segmented_regression(series, REGRESSION_KEYS, block_days=64, exact=True)


#: The series key of the original jobs.
ORIGINAL_KEYS = ["categoria", "year", "clave_producto"]


@query
def regression_by_product_year(spark, sf_dir):
    """The original jobs' series key: (category, year, product); two points a side, as its series are short here."""
    return segmented_regression(price_series(enriched(spark, sf_dir, "type"), ORIGINAL_KEYS), ORIGINAL_KEYS, min_points=2)


EDPELT_KEYS = ["categoria", "year"]


def edpelt_series(spark, sf_dir, extra=()):
    return price_series(enriched(spark, sf_dir, "brand"), EDPELT_KEYS, extra=extra)


@query
def edpelt_q(spark, sf_dir):
    return edpelt(edpelt_series(spark, sf_dir), EDPELT_KEYS)


#: Cost evaluations per series: about half of the (brand, year) series at sf0.01 end within it.
WORK_BUDGET = 1_500


@query
def edpelt_work_budget(spark, sf_dir):
    """One row per series of a search that a work budget ends: what was used, the best cost and a bound from below."""
    out = edpelt_within(edpelt_series(spark, sf_dir), EDPELT_KEYS, WORK_BUDGET)
    return out.select(*EDPELT_KEYS, "points", "dates", "evaluations", "status", F.round("cost", 4).alias("cost"),
                      F.round("lower_bound", 4).alias("lower_bound"),
                      F.array_join(F.transform("change_points", lambda c: F.date_format(c, "yyyy-MM-dd")), ", ").alias("change_points"))


@query
def edpelt_by_blocks(spark, sf_dir):
    """ED-PELT with every series cut in blocks of 64 days, the form for series of very many dates."""
    return edpelt_blocks(edpelt_series(spark, sf_dir), EDPELT_KEYS, block_days=64)


@query
def edpelt_partial_sums(spark, sf_dir):
    keys = EDPELT_KEYS
    vc = materialize(value_counts(edpelt_series(spark, sf_dir), keys))
    return partial_sums(threshold_histogram(vc, positions(vc, keys), keys), thresholds(vc, keys), keys)


def divide_series(spark, sf_dir):
    return edpelt_series(spark, sf_dir, extra=("clave_venta",))


@query
def divide_pelt_candidates(spark, sf_dir):
    keys = EDPELT_KEYS
    s = divide_series(spark, sf_dir)
    return divide.phase1(materialize(divide.segment_counts(s, keys)), s, keys)


@query
def divide_pelt_segments(spark, sf_dir):
    keys = EDPELT_KEYS
    s = divide_series(spark, sf_dir)
    return divide.segment_summary(divide.phase1(materialize(divide.segment_counts(s, keys)), s, keys), keys)


@query
def divide_pelt_q(spark, sf_dir):
    return divide.divide_pelt(divide_series(spark, sf_dir), EDPELT_KEYS)


@query
def conclusion_histogram(spark, sf_dir):
    return conclude.histogram(regression_result(spark, sf_dir), ["categoria", "year"])


@query
def conclusion_json(spark, sf_dir):
    return conclude.conclude(regression_result(spark, sf_dir), ["categoria", "year"])


@query
def conclusion_file(spark, sf_dir):
    """The single-file roll-up, written as `key<TAB>{json}` lines and read back: each line and how many files hold them."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/salescp-out-{uuid.uuid4().hex}"
    note_written(path)
    sinks.write_text(conclude.conclude(regression_result(spark, sf_dir), EDPELT_KEYS), path, EDPELT_KEYS, ["histogram"], single_file=True)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    files = lines.agg(F.countDistinct("file").alias("files"))
    return lines.select("value").join(F.broadcast(files))  # one row


SUPPLIER_KEYS = ["categoria", "year", "clave_local"]


def edpelt_supplier_result(spark, sf_dir):
    s = price_series(enriched(spark, sf_dir, "type"), SUPPLIER_KEYS)
    return edpelt(s, SUPPLIER_KEYS)


@query
def edpelt_by_supplier(spark, sf_dir):
    return edpelt_supplier_result(spark, sf_dir)


@query
def conclusion_json_edpelt(spark, sf_dir):
    return conclude.conclude(edpelt_supplier_result(spark, sf_dir), ["categoria", "year"])


PRODUCT_KEYS = ["categoria", "clave_producto"]  # with the year as well, no series of the fixture has a change


@query
def edpelt_by_product(spark, sf_dir):
    """The original jobs' series key, over all years: (category, product)."""
    s = price_series(enriched(spark, sf_dir, "brand"), PRODUCT_KEYS)
    return edpelt(s, PRODUCT_KEYS)


@query
def regression_by_product(spark, sf_dir):
    s = price_series(enriched(spark, sf_dir, "brand"), PRODUCT_KEYS)
    return segmented_regression(s, PRODUCT_KEYS)


EVENT_KEYS = ["event_type", "user_id"]


def event_series(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events")
    return ev.select("event_type", "user_id", F.col("ts").cast("date").alias("fecha"), F.col("value").cast("double")).filter(
        F.col("fecha").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))


@query
def events_edpelt(spark, sf_dir):
    """Second series source: daily event values per event type and user."""
    return edpelt(event_series(spark, sf_dir), EVENT_KEYS)


@query
def events_regression(spark, sf_dir):
    return segmented_regression(event_series(spark, sf_dir), EVENT_KEYS)


DEPARTMENT_KEYS = ["categoria", "year", "departamento"]


def department_series(spark, sf_dir):
    return price_series(enriched(spark, sf_dir, "type"), DEPARTMENT_KEYS, extra=("clave_venta",))


@query
def edpelt_by_department(spark, sf_dir):
    return edpelt(department_series(spark, sf_dir).drop("clave_venta"), DEPARTMENT_KEYS)


@query
def divide_pelt_by_department(spark, sf_dir):
    return divide.divide_pelt(department_series(spark, sf_dir), DEPARTMENT_KEYS)


@query
def edpelt_range_ranks(spark, sf_dir):
    """ED-PELT with the ranks of range-partitioned values, the form for keys of very many values."""
    return edpelt(edpelt_series(spark, sf_dir), EDPELT_KEYS, rank_strategy="range")


@query
def edpelt_radix_ranks(spark, sf_dir):
    """ED-PELT with positions from histogram refinement, no rank of every value."""
    return edpelt(edpelt_series(spark, sf_dir), EDPELT_KEYS, rank_strategy="radix")


@query
def conclusion_by_department(spark, sf_dir):
    """The roll-up that keeps the department: regression per product and store, by (category, department, year)."""
    keys = ["categoria", "departamento", "year"]
    s = price_series(enriched(spark, sf_dir, "type"), keys + ["clave_local"])
    return conclude.conclude(segmented_regression(s, keys + ["clave_local"]), keys)


@query
def conclusion_timeouts(spark, sf_dir):
    """Every series out of a budget of no time: `Timeout` counts per (category, year)."""
    s = price_series(enriched(spark, sf_dir, "type"), SUPPLIER_KEYS)
    return conclude.histogram(edpelt(s, SUPPLIER_KEYS, max_seconds=0), ["categoria", "year"])


def largest_jump(daily):
    """A user detector: the date before the largest step of the daily mean (first of equals)."""
    if len(daily) < 2:
        return []
    steps = daily["mean"].diff().abs().round(6).iloc[1:]
    return [daily["fecha"].iloc[int(steps.to_numpy().argmax())]]


@query
def user_detector(spark, sf_dir):
    s = price_series(enriched(spark, sf_dir, "type"), SUPPLIER_KEYS)
    return detect(s, SUPPLIER_KEYS, largest_jump)


def doubled_star(spark, sf_dir):
    """The star schema with further rows for some dimension keys (a rule on the key)."""
    v, p, l = fixtures.star(spark, sf_dir, "brand")
    more_p = p.where("clave % 3 = 0").select(
        F.expr(f"CASE WHEN clave % 2 = 0 THEN '{FIXTURE.excluded_category}' ELSE 'Brand#99' END").alias("categoria"), "clave")
    more_l = l.where("clave % 4 = 0").select(F.lit("ZZZ").alias("departamento"), "clave")
    return v, p.unionByName(more_p), l.unionByName(more_l)


@query
def duplicate_keys_inner(spark, sf_dir):
    """Duplicate dimension keys, hash-join form: pick, then filter."""
    return enrich(*doubled_star(spark, sf_dir), how="inner", filters=FIXTURE).select(*_ENRICHED_COLS)


@query
def duplicate_keys_left(spark, sf_dir):
    """Duplicate dimension keys, reduce-join form: filter, then pick."""
    return enrich(*doubled_star(spark, sf_dir), how="left", filters=FIXTURE).select(*_ENRICHED_COLS)


def native_lines(spark, sf_dir):
    """The sales as native `;` lines, some of them damaged (a rule on the sale's key)."""
    v = fixtures.ventas(spark, sf_dir)
    text_of = [F.col(c).cast("string") for c in v.columns]
    field = dict(zip(v.columns, text_of))
    key = F.col("clave_venta")
    field["cant_vta"] = F.when(key % 13 == 0, F.lit("dos")).otherwise(field["cant_vta"])
    field["fecha"] = F.when(key % 11 == 0, F.lit("2024-13-45")).otherwise(field["fecha"])
    line = F.concat_ws(";", *[field[c] for c in v.columns])
    short = F.concat_ws(";", *[field[c] for c in v.columns[:5]])
    return v.select(F.when(key % 17 == 0, short).otherwise(line).alias("value"))


@query
def text_sales(spark, sf_dir):
    """Text lines in: typed rows, damaged lines rejected, a bad date kept as text."""
    return text.parse_lines(native_lines(spark, sf_dir), text.VENTAS_LAYOUT, name="ventas").rows.select(
        "clave_local", "clave_producto", "fecha", "cant_vta", "precio_unitario", "clave_venta")


def written_lines(df: DataFrame, name: str, mode: str = "error", path: str | None = None) -> str:
    """A new folder of text files with these lines, in the shared folder."""
    if path is None:
        path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/salescp-lines-{uuid.uuid4().hex}"
        note_written(path)
    df.write.mode(mode).text(f"{path}/{name}")
    return path


@query
def text_rejects(spark, sf_dir):
    """The rejected lines of text files with their reasons; (file, block, line) tells them apart."""
    path = written_lines(native_lines(spark, sf_dir), "ventas")
    found = text.quarantine(spark, f"{path}/ventas", text.VENTAS_LAYOUT).rejects
    places = found.groupBy("file", "block", "line").count()
    one = places.agg(F.coalesce(F.max("count"), F.lit(0)).alias("lines_at_a_place"))
    return found.select("reason", F.substring_index("value", ";", 5).alias("five_fields")).join(F.broadcast(one))  # one row


@query
def text_last_duplicate(spark, sf_dir):
    """Product lines in two files, the second with other categories for some keys: the last line of a key counts."""
    p = fixtures.productos(spark, sf_dir, "brand")
    line = F.concat_ws(";", "categoria", F.col("clave").cast("string")).alias("value")
    path = written_lines(p.select(line), "productos/a")
    again = p.where("clave % 3 = 0").withColumn("categoria", F.concat(F.lit("AA"), F.col("clave").cast("string")))
    written_lines(again.select(line), "productos/b", path=path)
    rows = text.quarantine(spark, f"{path}/productos/*", text.PRODUCTOS_LAYOUT).rows
    return text.last_in_file_order(rows, "clave", "categoria")


@query
def text_dimensions(spark, sf_dir):
    """Product and store lines, each under a header line that is rejected."""
    out = []
    for df, layout in ((fixtures.productos(spark, sf_dir), text.PRODUCTOS_LAYOUT), (fixtures.locales(spark, sf_dir), text.LOCALES_LAYOUT)):
        name = layout[0][0]
        # a header line in place of every hundredth key's line
        lines = df.select(F.when(F.col("clave") % 100 == 0, F.lit(f"{name};clave")).otherwise(
            F.concat_ws(";", name, F.col("clave").cast("string"))).alias("value"))
        out.append(text.parse_lines(lines, layout, name=name).rows.select(
            F.lit(name).alias("tabla"), F.col(name).alias("valor"), "clave"))
    return out[0].unionByName(out[1])


@query
def text_price_points(spark, sf_dir):
    """Points of the series built from text lines: a bad date drops the point."""
    rows = text.parse_lines(native_lines(spark, sf_dir), text.VENTAS_LAYOUT, name="ventas").rows
    s = price_series(rows, ["clave_local"])
    return exact_sums(s, ["clave_local", "fecha"], F.col("value"), "suma", rows="n")


@query
def text_quantity_sum(spark, sf_dir):
    """Sum of a text column per store; what is no number counts as nothing."""
    lines = native_lines(spark, sf_dir).select(F.split("value", ";").alias("f"))
    rows = lines.select(F.expr("cast(f[0] as bigint)").alias("clave_local"), F.expr("get(f, 4)").alias("cant_vta"))
    return agg.sum_values(rows, "clave_local", "cant_vta", exact=True)


@query
def text_detections(spark, sf_dir):
    """Text lines out: one line per series with its change dates."""
    keys = REGRESSION_KEYS
    found = jobs.detections_text(regression_result(spark, sf_dir), keys)
    return sinks.text_lines(found, keys, ["dates"], sep=";")
