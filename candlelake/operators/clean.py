"""Cleaning of raw candles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlelake.schemas import CANDLE_COLUMNS, LONG_COLUMNS, TIMESTAMP_COLUMNS

CANDLE_KEY = ("timestamp", "symbol")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each key to one row per map task before the shuffle, so a key
    with very many copies sends few rows to the task that owns it.
    """
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def drop_duplicates(candles: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """One row per ``(timestamp, symbol)``.

    Rows of a key that differ are ordered by their other columns, so the
    survivor is the same in every run.
    """
    others = [F.col(c) for c in candles.columns if c not in key]
    return first_per_key(candles, key, others)


def clean_candles(candles: DataFrame) -> DataFrame:
    """Trim the symbol, drop rows with a null or NaN, drop duplicate keys."""
    trimmed = candles.withColumn("symbol", F.trim("symbol"))
    return drop_duplicates(trimmed.dropna())


def exclude_symbols(candles: DataFrame, symbols: Iterable[str]) -> DataFrame:
    return candles.where(~F.col("symbol").isin(list(symbols)))


def select_symbols(candles: DataFrame, symbols: Iterable[str]) -> DataFrame:
    return candles.where(F.col("symbol").isin(list(symbols)))


def union_sources(*sources: DataFrame, dedup: bool = False) -> DataFrame:
    """Bag union by name. Keys shared by two sources stay unless ``dedup``."""
    out = sources[0]
    for other in sources[1:]:
        out = out.unionByName(other)
    return drop_duplicates(out) if dedup else out


def from_date(candles: DataFrame, start: str, ts: str = "timestamp") -> DataFrame:
    """Keep candles of ``start`` and later.

    Written as a bound on the timestamp itself, which reaches the Parquet scan
    as a pushed filter; ``to_date(timestamp) >= start`` would not.
    """
    return candles.where(F.col(ts) >= F.lit(start).cast("date").cast("timestamp"))


def serving_projection(candles: DataFrame) -> DataFrame:
    """Types and derived columns of the serving table."""
    def typed(c: str) -> Column:
        if c == "symbol":
            return F.trim(c).alias(c)
        if c in TIMESTAMP_COLUMNS:
            return F.date_trunc("millisecond", F.col(c).cast("timestamp")).alias(c)
        return F.col(c).cast("long" if c in LONG_COLUMNS else "double").alias(c)

    return candles.select(*[typed(c) for c in CANDLE_COLUMNS]).withColumn(
        "date", F.to_date("timestamp")
    )
