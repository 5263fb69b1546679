"""Running products and peaks over series of any length, by an associative scan in two passes.

A stretch of a series is summed up by its product and by the highest running product in it; two neighbouring stretches ``a, b`` combine to
``(a.product * b.product, greatest(a.peak, a.product * b.peak))``. So every chunk of a series is walked on its own, the one row that sums up
each chunk is scanned, and what came before a chunk is applied to its rows. No task holds a whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "_chunk"


def running_product(df: DataFrame, key: str, order: str, factor: Column, chunk: Column) -> DataFrame:
    """Add ``product`` and ``peak``: the product of ``factor`` over a key's rows so far, and its highest value so far.

    ``order`` must be unique within ``key``, and ``chunk`` must not decrease with it. A null factor counts as 1. Keys may be null and
    then are one series.
    """
    tagged = df.withColumn(CHUNK, chunk).withColumn("_factor", F.coalesce(factor, F.lit(1.0)))
    so_far = W.partitionBy(key, CHUNK).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    walked = tagged.withColumn("_own", F.product("_factor").over(so_far)).withColumn("_high", F.max("_own").over(so_far))
    # pass 1: a row per chunk
    chunks = walked.groupBy(F.col(key).alias("_key"), F.col(CHUNK).alias("_at")).agg(
        F.max_by("_own", order).alias("_total"), F.max("_high").alias("_top")
    )
    # pass 2: what lies before each chunk
    earlier = W.partitionBy("_key").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    led = chunks.withColumn("_before", F.coalesce(F.product("_total").over(earlier), F.lit(1.0)))
    led = led.withColumn("_above", F.max(F.col("_before") * F.col("_top")).over(earlier))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(CHUNK) == F.col("_at"))
    joined = walked.join(led.drop("_total", "_top"), same)
    return joined.select(
        *df.columns,
        (F.col("_before") * F.col("_own")).alias("product"),
        F.greatest("_above", F.col("_before") * F.col("_high")).alias("peak"),
    )
