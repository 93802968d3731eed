"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import DATE_FORMAT


def as_date(df: DataFrame, name: str) -> Column:
    """`name` as a DateType column: text is parsed strictly (bad text -> NULL)."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    return F.try_to_date(col, DATE_FORMAT)


def year_text(df: DataFrame, name: str) -> Column:
    """Year of the sale as four-character text (first four characters of the date)."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.substring(col, 1, 4)
    return F.date_format(col.cast("date"), "yyyy")


def date_text(col: Column | str) -> Column:
    """Date to `yyyy-MM-dd` text."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, DATE_FORMAT)


def widen_float(col: Column | str) -> Column:
    """A float read as text and widened to double, as the series points are."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("float").cast("double")  # bad text -> NULL, never an ANSI error


def joined_text(col: Column | str, sep: str = ", ") -> Column:
    """Array of dates or text to one line, `", "`-separated."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


def json_histogram(entries: Column) -> Column:
    """`{"k1": n1, "k2": n2}` from an array<struct<token string, n long>>.

    Entries are ordered by count descending, then token ascending; the spacing
    is `": "` inside an entry and `", "` between entries.
    """
    ordered = F.array_sort(
        F.transform(entries, lambda e: F.struct((-e["n"]).alias("neg_n"), e["token"].alias("token"))),
    )
    parts = F.transform(
        ordered,
        lambda e: F.concat(F.lit('"'), e["token"], F.lit('": '), (-e["neg_n"]).cast("string")),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))
