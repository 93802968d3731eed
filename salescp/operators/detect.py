"""One entry point for the change-point detectors.

    detect(series, key_cols, method="edpelt" | "regression" | "divide" | callable)

Every method returns (key..., change_point date, status), one row per change;
a series without change gives no row, a series out of time budget gives one
row with status 'timeout' and a NULL date.  ED-PELT also takes a budget of work,
`max_evaluations`: a series over it gives what is known by then, status 'cut'.

A callable is a user detector.  It receives one key's per-date summary as a
pandas DataFrame sorted by date, with columns fecha (date), n (points),
mean (mean value) and m2 (sum of squared deviations from the date mean), and
returns the change dates.  The per-date rows lie by key and date, and
`mapInArrow` walks each batch key by key (a key cut by a batch edge goes on in
the next), so the exchange with Python is paid per batch, not per key; a worker
holds one batch plus one key, whose rows are bounded by the number of dates,
never by the number of sales.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import DIVIDE_SEGMENTS, MIN_POINTS, REGRESSION_RATIO
from .divide import divide_pelt
from .edpelt import edpelt, result_schema
from .regression import segmented_regression
from .series import daily_stats


def detect(series: DataFrame, key_cols: Sequence[str], method: str | Callable = "edpelt", *,
           min_points: int = MIN_POINTS, ratio: float = REGRESSION_RATIO, segments: int = DIVIDE_SEGMENTS,
           max_seconds: float | None = None, **kwargs) -> DataFrame:
    keys = list(key_cols)
    if callable(method):
        return _user_detector(series, keys, method)
    if method == "edpelt":
        return edpelt(series, keys, min_points=min_points, max_seconds=max_seconds, **kwargs)
    if method == "regression":
        return segmented_regression(series, keys, ratio=ratio, min_points=min_points)
    if method == "divide":
        return divide_pelt(series, keys, segments=segments, min_points=min_points, max_seconds=max_seconds,
                           **kwargs)
    raise ValueError(f"unknown detector {method!r}")


def _user_detector(series: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], list]) -> DataFrame:
    """One call of `fn` per key, over its per-date rows in date order.

    The window numbers a key's dates from 1, in Spark's own sense of equal keys
    (null, NaN); number 1 is where Python sees a new key.  The number of partitions
    is fixed because AQE would merge the small rows of this stage, which costs
    CPU rather than bytes, into few tasks.
    """
    parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    day = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("fecha").asc_nulls_last()))
    kinds = dict(series.dtypes)  # a NaN of a key is null in the result, as with the other detectors
    shown = [F.nanvl(k, F.lit(None)).alias(k) if kinds[k] in ("float", "double") else F.col(k) for k in keys]
    daily = daily_stats(series, keys).repartition(parts, *keys).select(
        *shown, "fecha", F.col("c").alias("n"), F.col("mean_d").alias("mean"), "m2", day.alias("_day"))
    schema = result_schema(series, keys)

    def answer(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        *columns, numbers = rows.columns
        bounds = np.append(np.flatnonzero(numbers.to_numpy() == 1), len(numbers))
        dates = rows.select(range(len(keys), len(columns))).to_pandas()
        at, found = [], []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            some = list(fn(dates.iloc[lo:hi].reset_index(drop=True)))
            at.extend([lo] * len(some))
            found.extend(pd.Timestamp(d) if isinstance(d, np.datetime64) else d for d in some)
        found = pd.Series(found, dtype="object")
        days = pa.Array.from_pandas(found, mask=found.isnull(), type=pa.date32())
        taken = rows.select(range(len(keys))).take(pa.array(at, pa.int64())).combine_chunks()
        return pa.Table.from_arrays([*taken.columns, days, pa.array(["ok"] * len(at), pa.string())], names=schema.names)

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of the last key, which may go on in the next batch
        for batch in batches:
            starts = np.flatnonzero(batch.column(batch.num_columns - 1).to_numpy() == 1)
            if len(starts):
                last = int(starts[-1])
                yield from answer([*held, batch.slice(0, last)]).to_batches()
                held, batch = [], batch.slice(last)
            held.append(batch)
        if held:
            yield from answer(held).to_batches()

    return daily.mapInArrow(run, schema)
