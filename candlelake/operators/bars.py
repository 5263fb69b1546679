"""Bars from ticks, roll-ups and per-symbol summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.schemas import CANDLE_COLUMNS


def _close_time(start: Column, unit: str) -> Column:
    return start + F.expr(f"INTERVAL 1 {unit.upper()}") - F.expr("INTERVAL 1 MILLISECOND")


# more than twice the largest id, so that times differ by more than any two ids
_ID_SPAN = "20000000000000000000"


def order_key(timestamp: str = "timestamp", tie_break: str | None = None) -> Column:
    """Order by time and then id, as one fixed-width number, which hash aggregates can hold."""
    if not tie_break:
        return F.col(timestamp)
    micros = F.unix_micros(timestamp).cast("decimal(17,0)")
    return (micros * F.lit(_ID_SPAN).cast("decimal(20,0)") + F.col(tie_break).cast("decimal(19,0)")).cast("decimal(38,0)")


def bars_from_ticks(ticks: DataFrame, unit: str) -> DataFrame:
    """Canonical candles from ticks ``(symbol, timestamp, tick_id, price, is_taker)``.

    Every aggregate combines map-side, so a symbol or slot with very many ticks
    reaches its reducer as one partial row per map task.
    """
    order = order_key("timestamp", "tick_id")
    taker = F.col("is_taker")
    bars = ticks.groupBy("symbol", F.date_trunc(unit, "timestamp").alias("slot")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.sum("price").alias("quote_asset_volume"),
        F.count_if(taker).cast("double").alias("taker_buy_base_asset_volume"),
        F.sum(F.when(taker, F.col("price")).otherwise(0.0)).alias("taker_buy_quote_asset_volume"),
    )
    return (
        bars.withColumnRenamed("slot", "timestamp")
        .withColumn("volume", F.col("number_of_trades").cast("double"))
        .withColumn("close_time", _close_time(F.col("timestamp"), unit))
        .select(CANDLE_COLUMNS)
    )


def rollup(candles: DataFrame, unit: str) -> DataFrame:
    """Tumbling OHLCV roll-up of candles to hours, days or longer units.

    Needs one candle per (symbol, timestamp). The order column is then a plain
    timestamp, so first and last price stay fixed-width hash aggregates.
    """
    rolled = candles.groupBy("symbol", F.date_trunc(unit, "timestamp").alias("slot")).agg(
        F.min_by("open", "timestamp").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "timestamp").alias("close"),
        *[
            F.sum(c).alias(c)
            for c in (
                "volume",
                "quote_asset_volume",
                "number_of_trades",
                "taker_buy_base_asset_volume",
                "taker_buy_quote_asset_volume",
            )
        ],
    )
    return (
        rolled.withColumnRenamed("slot", "timestamp")
        .withColumn("close_time", _close_time(F.col("timestamp"), unit))
        .select(CANDLE_COLUMNS)
    )


def daily_close(
    prices: DataFrame,
    price: str = "close",
    tie_break: str | None = None,
    symbols: Iterable[str] | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """Last price of every symbol and UTC day, of some symbols and days if they are named.

    The days ``start``..``end`` are compared as times, so they bound the scan.

    ``tie_break`` names an id that decides between rows of the same time;
    without it ``(symbol, timestamp)`` must be unique.
    """
    if symbols is not None:
        prices = prices.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        prices = prices.where(F.col("timestamp") >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        prices = prices.where(F.col("timestamp") < F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp"))
    order = order_key("timestamp", tie_break)
    return prices.groupBy("symbol", F.to_date("timestamp").alias("date")).agg(
        F.max_by(price, order).alias("close")
    )


def top_symbols(candles: DataFrame, k: int) -> DataFrame:
    """The ``k`` symbols with the largest traded volume."""
    totals = candles.groupBy("symbol").agg(
        F.sum("quote_asset_volume").alias("quote_volume"),
        F.sum("number_of_trades").alias("trades"),
    )
    return totals.orderBy(F.desc("quote_volume"), "symbol").limit(k)


def series_bounds(prices: DataFrame, price: str = "close", tie_break: str | None = None) -> DataFrame:
    """Rows, first and last time and final price per symbol and, as ``*``, overall.

    The overall row is built from the per-symbol rows; the data is read once.
    """
    order = order_key("timestamp", tie_break)
    last = F.struct(F.max("timestamp").alias("at"), F.max_by(price, order).alias("price"))
    per_symbol = prices.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"), last.alias("last")
    )
    doubled = per_symbol.withColumn("symbol", F.explode(F.array("symbol", F.lit("*"))))
    return (
        doubled.groupBy("symbol")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("first_ts").alias("first_ts"),
            F.max("last").alias("last"),
        )
        .select(
            "symbol",
            "n_rows",
            "first_ts",
            F.col("last.at").alias("last_ts"),
            F.to_date("last.at").alias("last_date"),
            F.col("last.price").alias("final_price"),
        )
    )
