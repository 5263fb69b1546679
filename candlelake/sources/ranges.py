"""Date and time ranges over landed candles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_date(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def day_range(df: DataFrame, day: str | dt.date, ts: str = "timestamp") -> DataFrame:
    """Rows of one UTC day, from midnight to one millisecond before the next."""
    start = _as_date(day).cast("timestamp")
    end = F.date_add(_as_date(day), 1).cast("timestamp") - F.expr("INTERVAL 1 MILLISECOND")
    return df.where(F.col(ts).between(start, end))


def backfill_range(
    df: DataFrame, start: str | dt.date | Column, today: str | dt.date | Column, ts: str = "timestamp"
) -> DataFrame:
    """Rows from ``start`` to 23:59 of the day before ``today``."""
    first = _as_date(start).cast("timestamp")
    last = _as_date(today).cast("timestamp") - F.expr("INTERVAL 1 MINUTE")
    return df.where((F.col(ts) >= first) & (F.col(ts) <= last))


def within_dates(
    df: DataFrame,
    start: str | dt.date | Column | None = None,
    end: str | dt.date | Column | None = None,
    date: str | Column = "date",
) -> DataFrame:
    """Keep dates in ``[start, end]``; a bound that is ``None`` does not apply."""
    column = F.col(date) if isinstance(date, str) else date
    if start is not None:
        df = df.where(column >= _as_date(start))
    if end is not None:
        df = df.where(column <= _as_date(end))
    return df
