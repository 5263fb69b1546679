"""Candle stream: parse, validate, deduplicate, summarise and archive.

The transformations accept batch and streaming frames alike. State is keyed by
``(symbol, open time)``, which spreads a busy symbol over all state partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.schemas import STREAM_CANDLE_SCHEMA

LATE_LIMIT = "5 minutes"


def message_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of text messages, one JSON object per line of the landed files."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parse_messages(messages: DataFrame, text: str = "value") -> DataFrame:
    """Typed candle columns, event time and ``is_malformed``.

    A message is malformed if it is not JSON or lacks a required field.
    """
    parsed = messages.select(F.from_json(text, STREAM_CANDLE_SCHEMA).alias("m")).select("m.*")
    required = ("symbol", "open", "high", "low", "close", "volume", "open_time", "is_closed")
    missing = F.lit(False)
    for column in required:
        missing = missing | F.col(column).isNull()
    return parsed.withColumn("is_malformed", missing).withColumn(
        "timestamp", F.timestamp_millis("open_time")
    )


def closed_candles(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Well-formed candles whose interval has ended; ``keep`` names further message fields to carry along."""
    kept = parsed.where(~F.col("is_malformed") & F.col("is_closed"))
    return kept.select("timestamp", "symbol", "open", "high", "low", "close", "volume", *keep)


def dedup_stream(candles: DataFrame, late_limit: str = LATE_LIMIT) -> DataFrame:
    """One row per (symbol, open time); rows older than the watermark are dropped."""
    return candles.withWatermark("timestamp", late_limit).dropDuplicatesWithinWatermark(
        ["symbol", "timestamp"]
    )


def hourly_stream(candles: DataFrame, late_limit: str | None = LATE_LIMIT) -> DataFrame:
    """Hourly OHLCV summary; an hour is emitted once the watermark has passed its end.

    Pass ``late_limit=None`` if an earlier step already set the watermark.
    """
    marked = candles.withWatermark("timestamp", late_limit) if late_limit else candles
    hours = marked.groupBy("symbol", F.window("timestamp", "1 hour").alias("hour"))
    return hours.agg(
        F.min_by("open", "timestamp").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "timestamp").alias("close"),
        F.sum("volume").alias("volume"),
    ).select(F.col("hour.start").alias("timestamp"), "symbol", "open", "high", "low", "close", "volume")


def open_hours(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The hours that a stopped ``hourly_stream`` still holds open, read from its state store; none was emitted yet.

    Only state is read: no message is read or aggregated again.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    # a row per stateful operator of the query
    (number,) = [r["operatorId"] for r in operators.where("operatorName = 'stateStoreSave'").select("operatorId").distinct().collect()]
    state = spark.read.format("statestore").option("operatorId", number).load(checkpoint)
    # buffers stand in the order of the aggregates; two of them share their names, so they are renamed by place
    buffers = "open:double,open_at:timestamp,high:double,low:double,close:double,close_at:timestamp,volume:double"
    held = state.select("key", F.col("value").cast(f"struct<{buffers}>").alias("v"))
    return held.select(F.col("key.window.start").alias("timestamp"), "key.symbol", "v.open", "v.high", "v.low", "v.close", "v.volume")


def archive_columns(candles: DataFrame) -> DataFrame:
    """Add the folder columns ``year`` and ``month`` of the archive."""
    return candles.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp"))


def with_latency(candles: DataFrame, ready_ms: str = "close_time") -> DataFrame:
    """Add the write time of the micro-batch and the milliseconds since the candle was complete.

    ``ready_ms`` is the message field, in milliseconds, that says when.
    """
    now = F.current_timestamp()
    return candles.withColumn("written_at", now).withColumn("latency_ms", F.unix_millis(now) - F.col(ready_ms))


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """A query keeps the shuffle partitions it starts with for its whole life."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if n:
        spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Process all landed data into Parquet and stop.

    The file sink's log and the checkpoint make each micro-batch count once;
    a restart with the same checkpoint goes on where the last run ended.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _state_partitions(stream.sparkSession, state_partitions):
        query = writer.start()
        query.awaitTermination()
    return query


def run_batches(
    stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Hand every micro-batch of all landed data to ``store(batch, batch_id)`` and stop.

    A micro-batch that failed half way comes again with the same number, so ``store`` should replace what it wrote for that number.
    """
    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _state_partitions(stream.sparkSession, state_partitions):
        query = writer.start()
        query.awaitTermination()
    return query


def land_unsettled(
    stream: DataFrame, settled_path: str, path: str, checkpoint: str, key: Sequence[str] = ("symbol", "timestamp"), state_partitions: int | None = None
) -> StreamingQuery:
    """Store the stream's rows whose key the batch table does not hold: what a batch load has settled never lands again.

    The batch table (folders by ``date``) is looked up anew for every micro-batch, so loads that come while the stream runs or stands
    still count from then on. Only the dates of the micro-batch are read from it. A repeated micro-batch overwrites its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        dates = batch.agg(F.min(F.to_date("timestamp")).alias("first"), F.max(F.to_date("timestamp")).alias("last")).first()
        settled = batch.sparkSession.read.parquet(settled_path).where(F.col("date").between(dates["first"], dates["last"]))
        new = batch.join(settled.select(*key), list(key), "left_anti").select(batch.columns)
        new.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_batches(stream, store, checkpoint, state_partitions)


def count_malformed(parsed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store row and malformed counts of every micro-batch.

    A repeated micro-batch overwrites its own folder, so counts are never added twice.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if("is_malformed").alias("n_malformed")
        ).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_batches(parsed, store, checkpoint)
