"""Rolling features of a stream, computed when candles arrive: a stored tail per symbol carries the look-back over micro-batches.

Micro-batch ``n`` reads the tails that the newest micro-batch before it left, so a repeated micro-batch meets the same tails and writes
the same rows into the same folders.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.functions import over_lookback
from candlelake.streaming.candles import run_batches


def _newest_before(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """Folder of the greatest finished micro-batch below ``batch_id``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{path}/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    numbers = [int(re.search(r"batch_id=(\d+)/_SUCCESS$", status.getPath().toString())[1]) for status in found]
    older = [n for n in numbers if n < batch_id]
    return f"{path}/batch_id={max(older)}" if older else None


def store_features(
    candles: DataFrame,
    columns: dict[str, Callable[[WindowSpec], Column]],
    rows: int,
    path: str,
    tails_path: str,
    checkpoint: str,
    chunk: str = "day",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Store every candle of a deduplicated stream with window columns that look back ``rows`` candles of its symbol.

    A tail holds the last ``rows`` candles of a symbol, so a micro-batch reads and writes a bounded number of rows per symbol, whatever the
    length of its history. Candles come in order of time, as far as one micro-batch and the next are concerned; one that is not newer than
    its symbol's tail would need the past to be computed again and is stored with ``is_late`` and null features.
    """
    names = candles.columns

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = _newest_before(spark, tails_path, batch_id)
        tails = spark.read.schema(batch.schema).parquet(folder) if folder else spark.createDataFrame([], batch.schema)
        newest = tails.groupBy("symbol").agg(F.max("timestamp").alias("_newest"))
        marked = batch.join(newest, "symbol", "left").withColumn(
            "is_late", F.coalesce(F.col("timestamp") <= F.col("_newest"), F.lit(False))
        )
        marked = marked.select(*names, "is_late", F.lit(True).alias("_new"))
        led = marked.where(~F.col("is_late")).unionByName(tails.select(*names, F.lit(False).alias("is_late"), F.lit(False).alias("_new")))
        computed = over_lookback(led, "symbol", "timestamp", rows, F.date_trunc(chunk, "timestamp"), columns)
        late = marked.where("is_late")
        out = computed.where("_new").drop("_new").unionByName(late.drop("_new"), allowMissingColumns=True)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        newest_first = W.partitionBy("symbol").orderBy(F.desc("timestamp"))
        kept = led.withColumn("_age", F.row_number().over(newest_first)).where(F.col("_age") <= rows).select(names)
        kept.write.mode("overwrite").parquet(f"{tails_path}/batch_id={batch_id}")

    return run_batches(candles, store, checkpoint, state_partitions)
