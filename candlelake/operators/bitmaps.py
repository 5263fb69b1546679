"""Presence of bars as bitmaps: one bit per slot of time.

A symbol needs ``per_day / 8`` bytes a day (180 for minutes), whatever the number of its rows. Bits are set map-side, so an
exchange carries one bitmap per symbol, block of days and map task, and never a row per bar. Bitmaps of several loads are merged by a bitwise
or; a bar that occurs in both counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# bits that one bitmap aggregate holds
BITS = 32_768


def _layout(unit_seconds: int) -> tuple[int, int]:
    """Slots of a day, and days of a block. Days must fill whole bytes, so that a day is a slice of its bitmap."""
    per_day, rest = divmod(86_400, unit_seconds)
    if rest or per_day % 8 or per_day > BITS:
        raise ValueError(f"a day has no whole number of bytes of {unit_seconds} second slots")
    return per_day, BITS // per_day


def _bit(bitmap: str, place: Column) -> Column:
    """Whether a bit is set; the lowest bit of a byte comes first."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def slot_bitmaps(candles: DataFrame, unit_seconds: int, symbol: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """``symbol, block, bitmap``: which slots of each block of days hold a candle. Rows without a time set no bit."""
    per_day, days = _layout(unit_seconds)
    seconds = F.unix_seconds(ts)
    day = F.floor(seconds / 86_400)
    slot = F.floor(F.pmod(seconds, F.lit(86_400)) / unit_seconds)
    keyed = candles.where(F.col(ts).isNotNull()).select(
        F.col(symbol).alias("symbol"),
        F.floor(day / days).cast("int").alias("block"),
        (F.pmod(day, F.lit(days)) * per_day + slot).cast("long").alias("place"),
    )
    return keyed.groupBy("symbol", "block").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of several loads as those of one load of all their rows."""
    return reduce(DataFrame.unionByName, bitmaps).groupBy("symbol", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def slots_per_day(bitmaps: DataFrame, unit_seconds: int) -> DataFrame:
    """``symbol, date, n_present`` of the days that hold a bar."""
    per_day, days = _layout(unit_seconds)
    size = per_day // 8
    day_bits = F.substring("bitmap", F.col("day") * size + 1, F.lit(size))
    by_day = bitmaps.select("symbol", "block", "bitmap", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day"))
    counted = by_day.select(
        "symbol",
        F.date_from_unix_date((F.col("block") * days + F.col("day")).cast("int")).alias("date"),
        F.bitmap_count(day_bits).alias("n_present"),
    )
    return counted.where(F.col("n_present") > 0)


def missing_slots(bitmaps: DataFrame, unit_seconds: int) -> DataFrame:
    """Missing bars per symbol and day, from its first day to the table's last; days without any bar included."""
    per_day, _ = _layout(unit_seconds)
    present = slots_per_day(bitmaps, unit_seconds)
    last = present.agg(F.max("date")).scalar()
    calendar = (
        present.groupBy("symbol")
        .agg(F.min("date").alias("first"))
        .select("symbol", F.explode(F.sequence(F.col("first"), last)).alias("date"))
    )
    return calendar.join(present, ["symbol", "date"], "left").select(
        "symbol",
        "date",
        F.coalesce("n_present", F.lit(0)).alias("n_present"),
        (F.lit(per_day) - F.coalesce("n_present", F.lit(0))).alias("n_missing"),
    )


def gaps(bitmaps: DataFrame, unit_seconds: int) -> DataFrame:
    """``symbol, gap_after, gap_before, n_missing``: runs of missing slots between two neighbouring bars of a symbol.

    Inside a block the set bits are walked in its row; a block meets only the last bar of the block before, so the window holds
    a row per block of days. Times are the starts of slots.
    """
    per_day, days = _layout(unit_seconds)
    size = per_day * days
    places = F.filter(F.sequence(F.lit(0), F.lit(size - 1)), lambda p: _bit("bitmap", p))
    numbers = F.transform(places, lambda p: F.col("block").cast("long") * size + p)
    held = bitmaps.select("symbol", "block", numbers.alias("bars")).where(F.size("bars") > 0)
    in_order = W.partitionBy("symbol").orderBy("block")
    led = held.withColumn("before", F.lag(F.element_at("bars", -1)).over(in_order))
    whole = F.concat(F.when(F.col("before").isNotNull(), F.array("before")).otherwise(F.array().cast("array<long>")), "bars")
    steps = led.select("symbol", whole.alias("bars")).select(
        "symbol",
        F.inline(
            F.zip_with(
                F.slice("bars", F.lit(1), F.size("bars") - 1),
                F.slice("bars", F.lit(2), F.size("bars") - 1),
                lambda a, b: F.struct(a.alias("low"), b.alias("high")),
            )
        ),
    )
    at = lambda c: F.timestamp_seconds(F.col(c) * unit_seconds)
    return steps.where(F.col("high") - F.col("low") > 1).select(
        "symbol",
        at("low").alias("gap_after"),
        at("high").alias("gap_before"),
        (F.col("high") - F.col("low") - 1).alias("n_missing"),
    )


def date_bitmaps(closes: DataFrame) -> DataFrame:
    """``symbol, block, bitmap``: the dates on which a symbol has a close, a bit per day."""
    day = F.unix_date("date")
    keyed = closes.where(F.col("date").isNotNull()).select(
        "symbol", F.floor(day / BITS).cast("int").alias("block"), F.pmod(day, F.lit(BITS)).cast("long").alias("place")
    )
    return keyed.groupBy("symbol", "block").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def common_dates(bitmaps: DataFrame, universe: DataFrame) -> DataFrame:
    """``date``: the dates that all symbols of ``universe`` share, by a bitwise and of their bitmaps; one row per block is left."""
    members = bitmaps.join(universe.select("symbol").distinct(), "symbol", "left_semi")
    size = universe.agg(F.countDistinct("symbol")).scalar()
    shared = members.groupBy("block").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("n"))
    # a block that some symbol lacks has no common date
    whole = shared.where(F.col("n") == size)
    places = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda p: _bit("bitmap", p))
    return whole.select("block", F.explode(places).alias("place")).select(
        F.date_from_unix_date((F.col("block") * BITS + F.col("place")).cast("int")).alias("date")
    )
