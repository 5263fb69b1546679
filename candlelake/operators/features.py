"""Rolling features of candles, computed in time chunks (see ``functions.lookback``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions import divide_or, over_lookback


def _rolling(df: DataFrame, rows: int, chunk: str, columns: dict) -> DataFrame:
    return over_lookback(df, "symbol", "timestamp", rows, F.date_trunc(chunk, "timestamp"), columns)


def _step_return(window) -> Column:
    previous = F.lag("close").over(window)
    return F.when(previous > 0, F.col("close") / previous - 1)


def bar_returns(candles: DataFrame, chunk: str = "day") -> DataFrame:
    """Return of every bar against the bar before it."""
    bars = candles.select("symbol", "timestamp", "close")
    return _rolling(bars, 1, chunk, {"ret": _step_return})


def moving_averages(candles: DataFrame, spans: Sequence[int] = (5, 15), chunk: str = "day") -> DataFrame:
    """Mean close over the last ``span`` bars, for each span."""
    bars = candles.select("symbol", "timestamp", "close")
    columns = {
        f"ma_{n}": lambda w, n=n: F.avg("close").over(w.rowsBetween(1 - n, 0)) for n in spans
    }
    return _rolling(bars, max(spans) - 1, chunk, columns)


def rolling_volatility(candles: DataFrame, span: int = 15, chunk: str = "day") -> DataFrame:
    """Sample standard deviation of the last ``span`` bar returns."""
    bars = candles.select("symbol", "timestamp", "close")
    columns = {
        "ret": _step_return,
        "volatility": lambda w: F.stddev_samp("ret").over(w.rowsBetween(1 - span, 0)),
    }
    return _rolling(bars, span, chunk, columns)


def spike_events(
    candles: DataFrame, span: int = 20, threshold: float = 3.0, chunk: str = "day"
) -> DataFrame:
    """Bars whose close or volume lies far from the ``span`` bars before them.

    The baseline excludes the bar itself and needs ``span`` bars.
    """
    bars = candles.select("symbol", "timestamp", "close", "volume")

    def score(column: str):
        def build(window) -> Column:
            before = window.rowsBetween(-span, -1)
            distance = F.col(column) - F.avg(column).over(before)
            scored = divide_or(distance, F.stddev_samp(column).over(before))
            return F.when(F.count(column).over(before) == span, scored).otherwise(0.0)

        return build

    scored = _rolling(bars, span, chunk, {"close_z": score("close"), "volume_z": score("volume")})
    is_price = F.abs("close_z") >= threshold
    is_volume = F.abs("volume_z") >= threshold
    return scored.where(is_price | is_volume).withColumns(
        {"price_spike": is_price.cast("int"), "volume_spike": is_volume.cast("int")}
    )
