"""How the operators' inputs are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlelake.operators.bars import bars_from_ticks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades: the event type is the symbol, the value its price."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"),
        (F.col("user_id") % 2 == 0).alias("is_taker"),
    )


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the user as the symbol: many symbols of which some are stale."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"),
    )


def candles(spark: SparkSession, sf_dir: str, unit: str = "minute") -> DataFrame:
    return bars_from_ticks(ticks(spark, sf_dir), unit)


def defect_of(bars: DataFrame):
    """Which defect the copy of a bar gets: its hour number modulo 11."""
    return F.pmod(F.floor(F.unix_seconds("timestamp") / 3600), F.lit(11))


def dirty_candles(spark: SparkSession, sf_dir: str, unit: str = "minute") -> DataFrame:
    """All bars, and one damaged copy of each.

    0 padded symbol, 1 null close, 2 NaN close, 3 exact copy, 4 same key with
    another close; moved 30 seconds: 5 open 0, 6 high below low, 7 high below
    close, 8 low above open, 9 negative volume, 10 volume 0 (valid).
    """
    bars = candles(spark, sf_dir, unit)
    d = defect_of(bars)
    moved = F.col("timestamp") + F.expr("INTERVAL 30 SECONDS")
    copies = bars.withColumn("d", d).select(
        F.when(F.col("d") >= 5, moved).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(F.col("d") == 0, F.concat(F.lit(" "), "symbol", F.lit(" ")))
        .otherwise(F.col("symbol"))
        .alias("symbol"),
        F.when(F.col("d") == 5, 0.0).otherwise(F.col("open")).alias("open"),
        F.when(F.col("d") == 6, F.col("low") - 1)
        .when(F.col("d") == 7, F.col("close") - 0.5)
        .otherwise(F.col("high"))
        .alias("high"),
        F.when(F.col("d") == 8, F.col("open") + 0.5).otherwise(F.col("low")).alias("low"),
        F.when(F.col("d") == 1, F.lit(None))
        .when(F.col("d") == 2, F.lit(float("nan")))
        .when(F.col("d") == 4, F.col("close") + 1)
        .otherwise(F.col("close"))
        .alias("close"),
        F.when(F.col("d") == 9, -1.0)
        .when(F.col("d") == 10, 0.0)
        .otherwise(F.col("volume"))
        .alias("volume"),
        "close_time",
        "quote_asset_volume",
        "number_of_trades",
        "taker_buy_base_asset_volume",
        "taker_buy_quote_asset_volume",
    )
    return bars.unionByName(copies)


def numbered_symbols(symbols: DataFrame) -> DataFrame:
    """Universe ``(symbol, ord)`` in name order. A universe is a short list."""
    order = W.orderBy("symbol")
    return symbols.select("symbol").distinct().withColumn("ord", F.row_number().over(order) - 1)


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes from events: the average value per type and day."""
    t = ticks(spark, sf_dir)
    return t.groupBy("symbol", F.to_date("timestamp").alias("date")).agg(F.avg("price").alias("close"))


def brand_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes from line items: a price index per brand and week.

    The constant keeps returns small where a week has few line items.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    week = F.to_date(F.date_trunc("week", F.col("l_shipdate").cast("timestamp")))
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.upper("p_brand").alias("symbol"), week.alias("date"))
        .agg((F.lit(100_000) + F.avg("l_extendedprice")).alias("close"))
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_symbols(table(spark, sf_dir, "part").select(F.upper("p_brand").alias("symbol")))


def priority_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes from orders: the average total per priority and day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("symbol"),
            F.to_date(F.col("o_orderdate").cast("timestamp")).alias("date"),
        )
        .agg(F.avg("o_totalprice").alias("close"))
    )


def coin_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly coin facts: the ``k`` of an event's properties is the coin."""
    facts = (
        table(spark, sf_dir, "events")
        .select(
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("snapshot_time"),
            F.concat(F.lit("coin-"), F.get_json_object("props", "$.k")).alias("coin_id"),
            "value",
        )
        .groupBy("snapshot_time", "coin_id")
        .agg(
            F.avg("value").alias("current_price"),
            F.round(F.sum("value"), 2).alias("market_cap"),
            F.count(F.lit(1)).cast("double").alias("total_volume"),
        )
    )
    by_cap = W.partitionBy("snapshot_time").orderBy(F.desc("market_cap"), "coin_id")
    # joined by coin and time, so no task holds the history of a coin
    day_before = facts.select(
        "coin_id", (F.col("snapshot_time") + F.expr("INTERVAL 1 DAY")).alias("snapshot_time"), F.col("current_price").alias("_before")
    )
    ranked = facts.withColumn("market_cap_rank", F.row_number().over(by_cap)).join(day_before, ["coin_id", "snapshot_time"], "left")
    return ranked.withColumn("price_change_24h", F.col("current_price") - F.col("_before")).select(
        *facts.columns, "market_cap_rank", "price_change_24h"
    )


def trending_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trending facts: every event of a coin is one entry of the list of its type."""
    return (
        table(spark, sf_dir, "events")
        .select(
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("snapshot_time"),
            F.concat(F.lit("coin-"), F.get_json_object("props", "$.k")).alias("coin_id"),
            (F.col("user_id") % 7 + 1).cast("int").alias("trending_rank"),
            F.col("event_type").alias("source"),
        )
    )


def coin_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin attributes from parts."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("coin-"), F.col("p_partkey").cast("string")).alias("coin_id"),
        F.col("p_partkey").cast("string").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("platform"),
    )


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle messages of the minute bars, by minute number ``m``.

    Every bar is sent closed; also a repeat if m % 3 = 0, an unclosed state if
    m % 2 = 0, and a broken line if m % 5 = 0.
    """
    bars = candles(spark, sf_dir, "minute").withColumn(
        "m", F.floor(F.unix_seconds("timestamp") / 60)
    )
    message = lambda closed: F.to_json(
        F.struct(
            "symbol", "open", "high", "low", "close", "volume",
            F.unix_millis("timestamp").alias("open_time"),
            F.unix_millis("close_time").alias("close_time"),
            F.lit(closed).alias("is_closed"),
        )
    )
    lines = F.array_compact(
        F.array(
            message(True),
            F.when(F.col("m") % 3 == 0, message(True)),
            F.when(F.col("m") % 2 == 0, message(False)),
            F.when(F.col("m") % 5 == 0, F.concat(F.lit('{"symbol": '), "symbol")),
        )
    )
    return bars.select(F.explode(lines).alias("value"))
