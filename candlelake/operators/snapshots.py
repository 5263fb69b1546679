"""Market snapshot tables: coins, trending lists and their daily metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAPSHOT_PAYLOAD_SCHEMA = (
    "snapshot_time timestamp, "
    "coins array<struct<coin_id:string,current_price:double,total_volume:double>>"
)


def flatten_snapshots(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """One row per coin of every snapshot payload; payloads that do not parse give none."""
    parsed = payloads.select(F.from_json(text, SNAPSHOT_PAYLOAD_SCHEMA).alias("p"))
    return parsed.select(F.col("p.snapshot_time").alias("snapshot_time"), F.inline("p.coins"))


# why a payload is rejected
NOT_JSON, NO_TIME, NO_COINS = "not JSON", "no snapshot_time", "no list of coins"


def parse_payloads(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """``payload, snapshot_time, coins, reject``: payloads as variants, so no field has to be known beforehand.

    ``coins`` is an array of variants. ``reject`` says why a payload gives no coins, and is null for a good one; no payload vanishes.
    """
    whole = payloads.select(F.col(text).alias("payload"), F.try_parse_json(text).alias("v"))
    read = whole.select(
        "payload",
        "v",
        F.try_variant_get("v", "$.snapshot_time", "timestamp").alias("snapshot_time"),
        F.try_variant_get("v", "$.coins", "array<variant>").alias("coins"),
    )
    reject = (
        F.when(F.isnull("v") | F.is_variant_null("v"), NOT_JSON)
        .when(F.isnull("snapshot_time"), NO_TIME)
        .when(F.isnull("coins"), NO_COINS)
    )
    return read.select("payload", "snapshot_time", "coins", reject.alias("reject"))


def flatten_variants(parsed: DataFrame, **more: str) -> DataFrame:
    """One row per coin of the good payloads, with the whole coin as a variant ``coin`` and further fields ``more`` (name: type) taken from it.

    A field that is missing or of another type is null in its column and unchanged in ``coin``.
    """
    coins = parsed.where(F.isnull("reject")).select("snapshot_time", F.explode("coins").alias("coin"))
    fields = {"coin_id": "string", "current_price": "double", "total_volume": "double", **more}
    return coins.select("snapshot_time", *(F.try_variant_get("coin", f"$.{n}", t).alias(n) for n, t in fields.items()), "coin")


def rejected_payloads(parsed: DataFrame) -> DataFrame:
    """``reject, n_payloads`` of the payloads that give no coins."""
    return parsed.where(F.isnotnull("reject")).groupBy("reject").agg(F.count(F.lit(1)).alias("n_payloads"))


def trending_frequency(trending: DataFrame) -> DataFrame:
    """How often each coin trended, per day."""
    return trending.groupBy(F.to_date("snapshot_time").alias("date"), "coin_id").agg(
        F.count(F.lit(1)).alias("times_trending"), F.min("trending_rank").alias("best_rank")
    )


def trending_totals(trending: DataFrame) -> DataFrame:
    """How often each coin trended overall, and on how many days."""
    return (
        trending_frequency(trending)
        .groupBy("coin_id")
        .agg(F.sum("times_trending").alias("times_trending"), F.count(F.lit(1)).alias("n_days"))
    )


def daily_coin_metrics(snapshots: DataFrame, trending: DataFrame) -> DataFrame:
    """Daily price, volume, trending, rank and volatility figures per coin.

    Both facts are aggregated to (date, coin) before they are joined. The rank
    change is the first minus the last rank of the day: positive means a rise.
    """
    daily = snapshots.groupBy(F.to_date("snapshot_time").alias("date"), "coin_id").agg(
        F.avg("current_price").alias("avg_price"),
        F.max("current_price").alias("max_price"),
        F.min("current_price").alias("min_price"),
        F.avg("total_volume").alias("avg_volume"),
        (
            F.min_by("market_cap_rank", "snapshot_time") - F.max_by("market_cap_rank", "snapshot_time")
        ).alias("rank_change"),
        F.coalesce(F.stddev_samp("current_price"), F.lit(0.0)).alias("volatility_score"),
    )
    counts = trending_frequency(trending).select("date", "coin_id", "times_trending")
    return daily.join(counts, ["date", "coin_id"], "left").withColumn(
        "times_trending", F.coalesce("times_trending", F.lit(0))
    )


def market_overview(snapshots: DataFrame, k: int = 5) -> DataFrame:
    """Report of the newest snapshot as rows ``(section, position, coin_id, value)``.

    Total capitalisation, mean 24-hour change, top gainers and losers, and
    volume leaders. Each top list is a distributed top-k.
    """
    newest = snapshots.agg(F.max("snapshot_time")).scalar()
    latest = snapshots.where(F.col("snapshot_time") == newest)

    def figure(section: str, value) -> DataFrame:
        return latest.agg(value.cast("double").alias("value")).select(
            F.lit(section).alias("section"),
            F.lit(1).alias("position"),
            F.lit("*").alias("coin_id"),
            "value",
        )

    def leaders(section: str, column: str, descending: bool) -> DataFrame:
        order = [F.desc("value") if descending else F.asc("value"), F.asc("coin_id")]
        top = (
            latest.where(F.col(column).isNotNull())
            .select("coin_id", F.col(column).cast("double").alias("value"))
            .orderBy(*order)
            .limit(k)
        )
        ranked = top.agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("value") if descending else F.col("value")).alias("key"),
                        "coin_id",
                        "value",
                    )
                )
            ).alias("rows")
        )
        return ranked.select(F.posexplode("rows").alias("i", "row")).select(
            F.lit(section).alias("section"),
            (F.col("i") + 1).alias("position"),
            "row.coin_id",
            "row.value",
        )

    parts = [
        figure("total_market_cap", F.sum("market_cap")),
        figure("mean_change_24h", F.avg("price_change_24h")),
        leaders("top_gainers", "price_change_24h", True),
        leaders("top_losers", "price_change_24h", False),
        leaders("volume_leaders", "total_volume", True),
    ]
    return reduce(DataFrame.unionByName, parts)


def first_seen(snapshots: DataFrame, attributes: DataFrame) -> DataFrame:
    """Coin dimension: every coin seen, with its first snapshot date and the attributes known of it."""
    seen = snapshots.groupBy("coin_id").agg(F.to_date(F.min("snapshot_time")).alias("first_seen_date"))
    return seen.join(attributes, "coin_id", "left").select(*attributes.columns, "first_seen_date")


def snapshot_quality(snapshots: DataFrame, expected_per_snapshot: int) -> DataFrame:
    """Null keys, repeated keys and incomplete snapshots, in one row.

    Rows are first counted per key, so a key with very many copies is folded
    before the shuffle.
    """
    per_key = snapshots.groupBy("snapshot_time", "coin_id").agg(F.count(F.lit(1)).alias("n"))
    null_key = F.col("coin_id").isNull() | F.col("snapshot_time").isNull()
    per_snapshot = per_key.groupBy("snapshot_time").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(null_key, F.col("n")).otherwise(0)).alias("null_keys"),
        F.count_if(~null_key & (F.col("n") > 1)).alias("duplicate_keys"),
        F.count_if(~null_key).alias("coins"),
    )
    return per_snapshot.agg(
        F.sum("rows").alias("n_rows"),
        F.sum("null_keys").alias("null_keys"),
        F.sum("duplicate_keys").alias("duplicate_keys"),
        F.count_if(F.col("coins") < expected_per_snapshot).alias("incomplete_snapshots"),
    )


def trend_versus_cap(trending: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Trending rank beside the market-cap rank of the same coin and snapshot."""
    ranks = snapshots.select("coin_id", "snapshot_time", "market_cap", "market_cap_rank")
    return trending.join(ranks, ["coin_id", "snapshot_time"]).withColumn(
        "rank_gap", F.col("market_cap_rank") - F.col("trending_rank")
    )
