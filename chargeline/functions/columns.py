"""Scalar column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """Round a double amount half-up at ``scale`` decimals, as an exact DECIMAL.

    Rounding goes through DECIMAL(18,6) first so that ``1.005`` rounds to
    ``1.01`` as its decimal text suggests, not by its binary value.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("decimal(18,6)"), scale).cast(f"decimal({precision},{scale})")


def exact_sum(col: Column | str) -> Column:
    """Order-independent sum of per-record double amounts (12 decimals), as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(28,12)")).cast("double")


def decimal_text(col: Column | str, scale: int = 2) -> Column:
    """Fixed-point text, e.g. ``12.50`` (half-up at ``scale``)."""
    return money(col, scale).cast("string")


def number_text(col: Column | str) -> Column:
    """Shortest plain text of an amount with at most two decimals: 1946, 6370.5, 0.25."""
    t = decimal_text(col, 2)
    return F.regexp_replace(F.regexp_replace(t, "0+$", ""), "\\.$", "")


def title_case(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def html_escape(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def ts_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock time, no zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_range(col: Column, lo: int, hi: int) -> Column:
    return (col >= lo) & (col <= hi)


def isin(col: Column, values: Iterable) -> Column:
    return col.isin(list(values))


# Zone-free handling of TIMESTAMP_NTZ values. ``date_format`` and ``date_trunc``
# route an NTZ value through the session time zone, which moves wall-clock
# times inside a daylight-saving gap; casts to string and date do not.
def ntz_text(col: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a TIMESTAMP_NTZ (fraction dropped)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)


def date_text(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a timestamp or date."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("date").cast("string")


def month_start(col: Column | str) -> Column:
    """First day of the month (DATE) of a timestamp or date."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trunc(c.cast("date"), "month")
