"""Reusable column expressions.

Conventions shared by every job:
* money is carried as LONG cents and divided by 100 only when a column is
  emitted, so sums are exact and independent of summation order;
* ratios are double divisions guarded by ``nullif(denominator, 0)``;
* timestamps are TIMESTAMP_NTZ (business time without zone).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """``nullif(trim(c), '')`` — trims spaces and maps the empty string to NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def completeness(cols: Iterable[str | Column]) -> Column:
    """Number of non-NULL columns among ``cols`` (a row-quality score)."""
    terms = [F.when(_col(c).isNotNull(), 1).otherwise(0) for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE, NULL when the denominator is 0 or NULL."""
    return _col(num).cast("double") / F.nullif(_col(den), F.lit(0)).cast("double")


def cents_to_amount(c: str | Column) -> Column:
    """LONG cents -> DOUBLE major units."""
    return _col(c).cast("double") / F.lit(100.0)


def second_boundaries(start: str | Column, end: str | Column) -> Column:
    """Signed count of whole-second boundaries crossed from ``start`` to ``end``.

    00:00:00.9 -> 00:00:01.1 counts 1 (elapsed-time flooring would give 0).
    Both arguments are zone-less timestamps; the session runs in UTC.
    """
    s = F.unix_seconds(_col(start).cast("timestamp"))
    e = F.unix_seconds(_col(end).cast("timestamp"))
    return e - s


def epoch_to_ntz(seconds: str | Column) -> Column:
    """Epoch seconds (LONG) -> TIMESTAMP_NTZ in UTC, independent of session zone."""
    return F.timestamp_add(
        "SECOND", _col(seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week of a date/timestamp, as DATE."""
    return F.date_trunc("week", _col(c)).cast("date")
