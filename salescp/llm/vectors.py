"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: str) -> Column:
    """True for a vector that is not null or empty, has finite components only, and is not zero."""
    return F.coalesce(F.expr(
        f"size(`{col}`) > 0 and forall(`{col}`, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))"
        f" and exists(`{col}`, x -> x <> 0)"), F.lit(False))


def matrix(blobs) -> np.ndarray:
    """Rows of equally long little-endian doubles."""
    return np.stack([np.frombuffer(b, dtype="<f8") for b in blobs])


def unit_rows(rng, n: int, d: int) -> np.ndarray:
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)
