"""Decode raw exchange payloads that already landed as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.schemas import (
    CANDLE_COLUMNS,
    DOUBLE_COLUMNS,
    KLINE_COLUMNS,
    KLINE_MESSAGE_SCHEMA,
    LONG_COLUMNS,
    TIMESTAMP_COLUMNS,
)


def _typed(column: str, raw: Column) -> Column:
    """Cast one raw string; text that does not parse becomes null."""
    if column in TIMESTAMP_COLUMNS:
        return F.timestamp_millis(raw.try_cast("long"))
    if column in LONG_COLUMNS:
        return raw.try_cast("long")
    if column in DOUBLE_COLUMNS:
        return raw.try_cast("double")
    return raw


def cast_kline_columns(raw: DataFrame) -> DataFrame:
    """Type the string columns of a kline table.

    Adds ``n_bad``: how many columns held text that does not parse. The source
    system fails on the first such value; a caller that wants the same can
    filter on ``n_bad`` or raise.
    """
    typed_names = set(TIMESTAMP_COLUMNS + LONG_COLUMNS + DOUBLE_COLUMNS) & set(raw.columns)
    bad = sum(
        (
            F.when(_typed(c, F.col(c)).isNull(), 1).otherwise(0)
            for c in raw.columns
            if c in typed_names
        ),
        F.lit(0),
    )
    return raw.select(*[_typed(c, F.col(c)).alias(c) for c in raw.columns], bad.alias("n_bad"))


def decode_kline_arrays(payloads: DataFrame, text: str = "payload", symbol: str = "symbol") -> DataFrame:
    """One row per kline from API pages: a JSON array of 12-slot arrays per row."""
    klines = payloads.select(
        F.col(symbol).alias("symbol"),
        F.explode(F.from_json(text, "array<array<string>>")).alias("slots"),
    )
    named = klines.select(
        "symbol", *[F.get("slots", F.lit(i)).alias(c) for i, c in enumerate(KLINE_COLUMNS)]
    )
    return cast_kline_columns(named).select(*CANDLE_COLUMNS, "ignore", "n_bad")


def decode_kline_messages(messages: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten ``{"k": {...}}`` messages to six columns; batch or stream."""
    parsed = messages.select(*keep, F.from_json(text, KLINE_MESSAGE_SCHEMA).alias("m"))
    fields = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
    return parsed.select(
        *keep,
        F.timestamp_millis("m.k.t").alias("timestamp"),
        *[F.col(f"m.k.{slot}").try_cast("double").alias(c) for c, slot in fields.items()],
    )
