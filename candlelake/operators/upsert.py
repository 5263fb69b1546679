"""Read-time resolution of several versions of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.operators.clean import CANDLE_KEY, first_per_key


def latest_wins(rows: DataFrame, key: Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest version, of equal versions the greatest in its other columns."""
    versions = [version] if isinstance(version, str) else list(version)
    others = [c for c in rows.columns if c not in key and c not in versions]
    return first_per_key(rows, key, [F.desc(c) for c in [*versions, *others]])


def batch_over_stream(
    batch: DataFrame, stream: DataFrame, key: Sequence[str] = CANDLE_KEY
) -> DataFrame:
    """Union of both sources in which the batch row of a key replaces stream rows."""
    tagged = batch.withColumn("source", F.lit("batch")).unionByName(
        stream.withColumn("source", F.lit("stream"))
    )
    others = [F.col(c) for c in batch.columns if c not in key]
    return first_per_key(tagged, key, [F.col("source"), *others])
