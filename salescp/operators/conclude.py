"""Roll change points up into a histogram per coarser key.

A detector result (key..., change_point, status) is re-keyed to fewer
columns (e.g. drop product and store) and each token is counted: the date as
`yyyy-MM-dd` text, or `Timeout` for a series that ran out of time.  The JSON
form orders entries by count descending, then by token.

Rows per rolled-up key are bounded by its number of distinct dates, so the
`collect_list` behind the JSON is bounded too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_text, json_histogram
from ..params import TIMEOUT_TOKEN


def histogram(results: DataFrame, rollup_cols: Sequence[str]) -> DataFrame:
    """(rollup..., token, n), occurrences of each change date (or time-out) per rolled-up key."""
    token = F.when(F.col("status") == "timeout", F.lit(TIMEOUT_TOKEN)).otherwise(date_text("change_point"))
    tokens = results.select(*rollup_cols, F.trim(token).alias("token")).filter(
        F.col("token").isNotNull() & (F.col("token") != ""))
    return tokens.groupBy(*rollup_cols, "token").agg(F.count(F.lit(1)).alias("n"))


def histogram_json(hist: DataFrame, rollup_cols: Sequence[str]) -> DataFrame:
    """(rollup..., histogram), `{"d1": 3, "d2": 1}`, count descending then token."""
    return hist.groupBy(*rollup_cols).agg(
        json_histogram(F.collect_list(F.struct("token", "n"))).alias("histogram"))


def conclude(results: DataFrame, rollup_cols: Sequence[str], as_json: bool = True) -> DataFrame:
    hist = histogram(results, rollup_cols)
    return histogram_json(hist, rollup_cols) if as_json else hist
