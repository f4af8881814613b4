"""Effective-date rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.cols import ColumnLike, col


def day(value: ColumnLike) -> Column:
    return F.to_date(col(value))


def valid_on(start: ColumnLike, end: ColumnLike, as_of: ColumnLike) -> Column:
    """Inclusive on both ends, open where a bound is null, false when the date is unknown."""
    d = day(as_of)
    after = F.coalesce(day(start) <= d, day(start).isNull())
    before = F.coalesce(d <= day(end), day(end).isNull())
    return d.isNotNull() & after & before
