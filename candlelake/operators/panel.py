"""Aligned price panel, returns and their moments.

The inputs are daily closes: one row per symbol and date, far smaller than the
candles. Several steps read them more than once, so jobs should pass closes
that are already stored (see ``plans.staging``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def common_dates(closes: DataFrame, universe: DataFrame) -> DataFrame:
    """Dates on which every universe symbol has a close."""
    members = closes.join(universe.select("symbol"), "symbol", "left_semi")
    per_date = members.groupBy("date").agg(F.count(F.lit(1)).alias("n_symbols"))
    return per_date.where(F.col("n_symbols") == _row_count(universe)).select("date")


def _kept_dates(
    closes: DataFrame,
    universe: DataFrame,
    lookback: int,
    min_history: int,
    recent_days: int | None = None,
) -> Column:
    """The dates of the panel as one array of at most ``lookback + 1`` dates.

    Closes are first counted per date, so what meets in one task is one row per
    calendar date. Whether a date is common does not depend on the window
    chosen, hence the recent window and its fallback share this single pass.
    """
    members = universe.select("symbol", F.lit(True).alias("member"))
    per_date = (
        closes.join(members, "symbol", "left")
        .groupBy("date")
        .agg(F.count_if("member").alias("n_symbols"))
    )
    is_common = F.col("n_symbols") == _row_count(universe)
    calendar = per_date.agg(
        F.max("date").alias("newest"),
        F.sort_array(F.collect_list(F.when(is_common, F.col("date")))).alias("dates"),
    )
    need = min_history + 1
    chosen = F.col("dates")
    if recent_days is not None:
        start = F.date_sub("newest", recent_days)
        recent = F.filter("dates", lambda d: d >= start)
        chosen = F.when(F.size(recent) >= need, recent).otherwise(F.col("dates"))
    tail = F.slice("chosen", F.greatest(F.size("chosen") - lookback, F.lit(1)), lookback + 1)
    nothing = F.array().cast("array<date>")
    kept = F.when(F.size("chosen") >= need, tail).otherwise(nothing)
    return calendar.select(chosen.alias("chosen")).select(kept.alias("kept")).scalar()


def _panel(closes: DataFrame, universe: DataFrame, kept: Column) -> DataFrame:
    # the first and last date bound the scan; the array decides
    first, last = F.get(kept, F.lit(0)), F.get(kept, F.size(kept) - 1)
    return (
        closes.where(F.col("date").between(first, last) & F.array_contains(kept, F.col("date")))
        .join(universe.select("symbol", "ord"), "symbol")
        .select("symbol", "ord", "date", "close")
    )


def aligned_panel(
    closes: DataFrame, universe: DataFrame, lookback: int, min_history: int
) -> DataFrame:
    """Closes on the last ``lookback + 1`` dates common to all symbols.

    The panel is empty when fewer than ``min_history + 1`` such dates exist;
    ``require_history`` turns that into an error.
    """
    return _panel(closes, universe, _kept_dates(closes, universe, lookback, min_history))


def panel_with_fallback(
    closes: DataFrame,
    universe: DataFrame,
    lookback: int,
    buffer: int,
    min_history: int,
    period_days: int = 1,
) -> DataFrame:
    """Aligned panel of the recent window, or of all history if that is too short."""
    recent_days = (lookback + buffer) * period_days
    return _panel(
        closes, universe, _kept_dates(closes, universe, lookback, min_history, recent_days)
    )


def require_history(panel: DataFrame, min_history: int) -> DataFrame:
    """Fail at run time unless the panel has ``min_history + 1`` dates."""
    n_dates = panel.agg(F.countDistinct("date")).scalar()
    short = F.raise_error(
        F.concat(F.lit(f"need at least {min_history + 1} common dates, got "), n_dates.cast("string"))
    ).cast("boolean")
    # one extra row carries the check even if the panel itself is empty
    check = panel.agg(F.when(n_dates >= min_history + 1, F.lit(True)).otherwise(short).alias("ok"))
    return panel.where(check.scalar())


def asset_returns(panel: DataFrame, fail_on_bad_price: bool = True) -> DataFrame:
    """Simple return against the previous aligned date; the first date has none.

    A previous close that is not positive fails the run, or yields a null
    return if ``fail_on_bad_price`` is off. A symbol has at most
    ``lookback + 1`` rows here.
    """
    window = W.partitionBy("symbol").orderBy("date")
    stepped = panel.withColumn("previous", F.lag("close").over(window)).where(
        F.col("previous").isNotNull()
    )
    bad = (
        F.raise_error(F.concat(F.lit("close is not positive for "), F.col("symbol"))).cast("double")
        if fail_on_bad_price
        else F.lit(None).cast("double")
    )
    ret = F.when(F.col("previous") > 0, F.col("close") / F.col("previous") - 1).otherwise(bad)
    return stepped.select("symbol", "ord", "date", ret.alias("ret"))


def return_stats(returns: DataFrame) -> DataFrame:
    """Mean and sample standard deviation (0 for a single return) per symbol."""
    return returns.groupBy("symbol", "ord").agg(
        F.avg("ret").alias("mean_return"),
        F.coalesce(F.stddev_samp("ret"), F.lit(0.0)).alias("stddev_return"),
        F.count("ret").alias("n_returns"),
    )
