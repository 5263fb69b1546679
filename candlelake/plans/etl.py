"""Candle ETL jobs: bulk load, daily ingest and the serving load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.operators.clean import clean_candles, from_date, serving_projection, union_sources
from candlelake.operators.features import spike_events
from candlelake.operators.quality import quality_strict
from candlelake.operators.upsert import latest_wins
from candlelake.plans.staging import staged
from candlelake.schemas import CANDLE_COLUMNS
from candlelake.sinks import (
    append_missing_dates,
    existing_dates,
    replace_partitions,
    with_month,
    write_by_date,
    write_partitioned,
)
from candlelake.sources import read_csv_archive, read_day, read_partitioned, within_dates


def silver_candles(*sources: DataFrame, start: str | None = None, dedup: bool = False) -> DataFrame:
    """Clean every source, unite them and keep candles that pass the quality rules.

    Deduplication precedes the quality filter, and by default it runs within
    each source only; ``dedup`` also resolves keys shared by two sources.
    """
    united = union_sources(*[clean_candles(s) for s in sources], dedup=dedup)
    good = quality_strict(united)
    return from_date(good, start) if start else good


def bulk_load(
    spark: SparkSession,
    csv_root: str,
    lake_root: str,
    target: str,
    exclude: Iterable[str] = (),
    start: str | None = None,
    append: bool = False,
) -> None:
    """CSV archive and Parquet lake to date-partitioned silver candles."""
    archive = read_csv_archive(spark, csv_root, exclude)
    lake = read_partitioned(spark, lake_root).select(CANDLE_COLUMNS)
    write_by_date(silver_candles(archive, lake, start=start), target, "append" if append else "overwrite")


def daily_ingest(spark: SparkSession, bronze: str, target: str, day: str | dt.date) -> None:
    """One bronze day to silver; a day that is already there is left alone."""
    append_missing_dates(silver_candles(read_day(spark, bronze, day)), target)


def backfill(candles: DataFrame, target: str, start: str | dt.date, end: str | dt.date) -> None:
    """Replace the dates ``start``..``end`` of the silver table; other dates stay.

    A date of the range for which there are no candles is emptied. Running it again gives the
    same table, so it also repairs partial days.
    """
    dated = within_dates(candles.withColumn("date", F.to_date("timestamp")), start, end)
    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    stale = [d for d in existing_dates(candles.sparkSession, target) if first <= d <= last]
    replace_partitions(dated, target, ["date"], [f"date={d}" for d in stale])


def store_spikes(candles: DataFrame, target: str, start: str | dt.date, end: str | dt.date, **options) -> None:
    """Store the outlier events of the dates ``start``..``end`` in a table by date, and replace those found there before.

    Bars before ``start`` serve as look-back. Running it again, or for a range that overlaps, gives the same table.
    """
    found = spike_events(candles.where(F.to_date("timestamp") <= F.lit(str(end)).cast("date")), **options)
    dated = within_dates(found.withColumn("date", F.to_date("timestamp")), start, end)
    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    stale = [d for d in existing_dates(candles.sparkSession, target) if first <= d <= last]
    replace_partitions(dated, target, ["date"], [f"date={d}" for d in stale])


def serving_load(silver: DataFrame, target: str) -> None:
    """Append candles to the serving table, partitioned by month."""
    rows = serving_projection(silver).withColumn("ingested_at", F.current_timestamp())
    write_partitioned(with_month(rows), target, ["month"], mode="append")


def read_serving(spark: SparkSession, target: str) -> DataFrame:
    """All stored versions; folder names are read as text."""
    found = spark.read.parquet(target).schema
    typed = T.StructType([T.StructField("month", T.StringType()) if f.name == "month" else f for f in found])
    return spark.read.schema(typed).parquet(target)


def serving_view(spark: SparkSession, target: str) -> DataFrame:
    """The serving table with the newest version of every candle.

    The month follows from the time, so it is part of the key: a filter on it then reaches the folders.
    """
    return latest_wins(read_serving(spark, target), ["month", "symbol", "timestamp"], "ingested_at")


def compact_serving(spark: SparkSession, target: str, month: str) -> None:
    """Rewrite one month of the serving table with only the newest versions."""
    newest = serving_view(spark, target).where(F.col("month") == month)
    # stored first: a folder cannot be read and replaced in the same job
    replace_partitions(staged(newest, "compact"), target, ["month"])
