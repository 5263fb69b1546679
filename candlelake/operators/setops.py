"""Set operations on symbols and the freshness split of a universe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symbols_of(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def common_symbols(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("symbol").intersect(right.select("symbol"))


def one_sided_symbols(left: DataFrame, right: DataFrame) -> DataFrame:
    """Symbols found on one side only, with the side."""
    a, b = left.select("symbol"), right.select("symbol")
    return (
        a.subtract(b)
        .withColumn("side", F.lit("left"))
        .unionByName(b.subtract(a).withColumn("side", F.lit("right")))
    )


def fresh_symbols(prices: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Symbols whose newest date is the newest date of the whole table."""
    last = prices.groupBy("symbol").agg(F.max(F.to_date(ts)).alias("last_date"))
    return last.where(F.col("last_date") == last.agg(F.max("last_date")).scalar())


def usable_universe(universe: DataFrame, fresh: DataFrame) -> DataFrame:
    """Universe rows that are fresh; the order column stays as it was."""
    return universe.join(fresh.select("symbol"), "symbol", "left_semi")


def skipped_symbols(universe: DataFrame, fresh: DataFrame) -> DataFrame:
    """Universe rows that are absent from the data or stale."""
    return universe.join(fresh.select("symbol"), "symbol", "left_anti")
