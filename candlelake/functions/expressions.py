"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds of the score bands, and the label above both.
SCORE_BANDS = ((0.35, "Low"), (0.65, "Medium"))
TOP_BAND = "High"


def divide_or(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``default``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


def hashed_uniform(seed: int, *parts: Column) -> Column:
    """Uniform number in (0, 1) that depends only on the seed and the key parts.

    Unlike ``rand(seed)`` the draw does not change with the partitioning, so a
    recomputed task yields the same numbers. 52 bits of an MD5 digest are used.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def diversification_label(score: Column) -> Column:
    label = F.lit(TOP_BAND)
    for bound, name in reversed(SCORE_BANDS):
        label = F.when(score < bound, F.lit(name)).otherwise(label)
    return label


def ohlc_rules() -> dict[str, Column]:
    """The candle quality rules by family; a good candle satisfies all of them."""
    o, h, l, c = (F.col(name) for name in ("open", "high", "low", "close"))
    return {
        "positive_prices": (o > 0) & (h > 0) & (l > 0) & (c > 0),
        "high_is_highest": (h >= l) & (h >= o) & (h >= c),
        "low_is_lowest": (l <= o) & (l <= c),
        "volume_not_negative": F.col("volume") >= 0,
    }
