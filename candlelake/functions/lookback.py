"""Row-frame windows over keys of any size.

A window partitioned by symbol alone puts the whole history of a symbol into
one task. Here each symbol's history is cut into time chunks, and every chunk
gets a copy of the few rows that precede it, so a frame of bounded length gives
the same answer inside the chunk as it would over the whole history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "_chunk"
BORROWED = "_borrowed"


def with_lookback(df: DataFrame, key: str, order: str, rows: int, chunk: Column) -> DataFrame:
    """Tag rows with their chunk and add the ``rows`` rows before each chunk.

    ``order`` must be unique within ``key`` and ``chunk`` must not decrease
    with it. The borrowed rows carry ``_borrowed = true``. The number of rows
    taken from a chunk is limited before the shuffle (``row_number <= rows``
    becomes a map-side group limit). A chunk is lent the tails of the chunks that hold
    the last ``rows`` rows before it, found by the running number of tail rows: fewer than
    ``2 * rows`` records, however short the chunks are.
    """
    tagged = df.withColumn(CHUNK, chunk)
    record = F.struct(order, *[c for c in df.columns if c not in (key, order)])

    newest_first = W.partitionBy(key, CHUNK).orderBy(F.desc(order))
    tails = (
        tagged.withColumn("_age", F.row_number().over(newest_first))
        .where(F.col("_age") <= rows)
        .groupBy(key, CHUNK)
        .agg(F.sort_array(F.collect_list(record)).alias("_tail"))
    )
    in_order = W.partitionBy(key).orderBy(CHUNK)
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    last_rows = W.partitionBy(key).orderBy("_rows").rangeBetween(-(rows - 1), 0)
    borrowed = (
        tails.withColumn("_rows", F.sum(F.size("_tail")).over(so_far))
        .withColumn("_next", F.lead(CHUNK).over(in_order))
        .withColumn("_lead", F.flatten(F.collect_list("_tail").over(last_rows)))
        .where(F.col("_next").isNotNull())
        .withColumn(CHUNK, F.col("_next"))
        .withColumn("_lead", F.slice("_lead", -F.least(F.size("_lead"), F.lit(rows)), rows))
        .select(key, CHUNK, F.inline("_lead"))
        .withColumn(BORROWED, F.lit(True))
    )
    return tagged.withColumn(BORROWED, F.lit(False)).unionByName(borrowed)


def over_lookback(
    df: DataFrame,
    key: str,
    order: str,
    rows: int,
    chunk: Column,
    columns: dict[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Add window columns that look back at most ``rows`` rows.

    Each entry of ``columns`` receives the ordered window and returns the
    column; later entries may use earlier ones.
    """
    window = W.partitionBy(key, CHUNK).orderBy(order)
    out = with_lookback(df, key, order, rows, chunk)
    for name, build in columns.items():
        out = out.withColumn(name, build(window))
    return out.where(~F.col(BORROWED)).drop(CHUNK, BORROWED)
