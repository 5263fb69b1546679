"""Metrics of the jobs that write, observed while they write: no second pass over the rows.

Every run or micro-batch stores one row. A micro-batch that is repeated after a failure replaces its own row, so sums over the table
count every message once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.functions import ohlc_rules
from candlelake.streaming.candles import closed_candles, run_batches

METRICS = (
    "n_rows long, n_malformed long, n_unclosed long, n_violations long, n_stored long, n_duplicates long, newest timestamp, lag_seconds long"
)


def _violated() -> Column:
    return ~F.coalesce(reduce(Column.__and__, ohlc_rules().values()), F.lit(False))


def write_observed(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
    before: dict[str, Column],
    after: dict[str, Column],
) -> dict:
    """Run ``write(transform(rows))`` once and return what was observed on both sides of ``transform``.

    Metrics are aggregates. Spark adds up those of finished tasks; tasks that run again because an executor was lost while a later stage needed their
    output count again in ``before``.
    """
    seen, kept = Observation(), Observation()
    landed = rows.observe(seen, *(c.alias(name) for name, c in before.items()))
    write(transform(landed).observe(kept, *(c.alias(name) for name, c in after.items())))
    return {**seen.get, **kept.get}


def _store(spark: SparkSession, found: dict, path: str, now: Column) -> None:
    """One row of metrics, with the age of the newest candle at ``now``."""
    names = [n for n in ("n_rows", "n_malformed", "n_unclosed", "n_violations", "n_stored", "n_closed", "newest")]
    row = spark.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"{n} {'timestamp' if n == 'newest' else 'long'}" for n in names))
    row.select(
        "n_rows", "n_malformed", "n_unclosed", "n_violations", "n_stored",
        (F.col("n_closed") - F.col("n_stored")).alias("n_duplicates"),
        "newest",
        (F.unix_seconds(now) - F.unix_seconds("newest")).alias("lag_seconds"),
    ).write.mode("overwrite").parquet(path)


def archive_with_metrics(
    parsed: DataFrame, path: str, metrics_path: str, checkpoint: str, now: Column | None = None, state_partitions: int | None = None
) -> StreamingQuery:
    """Archive the closed candles of parsed messages, once per key and micro-batch, and store the metrics of each micro-batch.

    ``n_rows`` messages, of which ``n_malformed`` are no messages, ``n_unclosed`` belong to candles still running, and ``n_duplicates`` repeat a key
    of the micro-batch; ``n_violations`` stored candles break a price rule. ``newest`` is the latest candle and ``lag_seconds`` its age.
    """
    well_formed = ~F.col("is_malformed")
    before = {
        "n_rows": F.count(F.lit(1)),
        "n_malformed": F.count_if("is_malformed"),
        "n_unclosed": F.count_if(well_formed & ~F.col("is_closed")),
        "n_closed": F.count_if(well_formed & F.col("is_closed")),
    }
    after = {"n_stored": F.count(F.lit(1)), "n_violations": F.count_if(_violated()), "newest": F.max("timestamp")}

    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch_id={batch_id}"
        found = write_observed(
            batch,
            lambda rows: closed_candles(rows).dropDuplicates(["symbol", "timestamp"]),
            lambda rows: rows.write.mode("overwrite").parquet(f"{path}/{folder}"),
            before,
            after,
        )
        _store(batch.sparkSession, found, f"{metrics_path}/{folder}", F.current_timestamp() if now is None else now)

    return run_batches(parsed, store, checkpoint, state_partitions)


def load_with_metrics(
    candles: DataFrame, transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], metrics_path: str, run_id: str
) -> DataFrame:
    """Run a batch load and store its row ``run_id, rows_before, rows_after, rows_dropped, n_violations, n_incomplete``; the table of all runs.

    A run that is repeated under its id replaces its row.
    """
    prices = ("open", "high", "low", "close", "volume")
    incomplete = reduce(Column.__or__, [F.col(c).isNull() | F.isnan(c) for c in prices])
    before = {"rows_before": F.count(F.lit(1)), "n_incomplete": F.count_if(incomplete), "n_violations": F.count_if(~incomplete & _violated())}
    found = write_observed(candles, transform, write, before, {"rows_after": F.count(F.lit(1))})
    spark = candles.sparkSession
    row = spark.createDataFrame(
        [(found["rows_before"], found["rows_after"], found["rows_before"] - found["rows_after"], found["n_violations"], found["n_incomplete"])],
        "rows_before long, rows_after long, rows_dropped long, n_violations long, n_incomplete long",
    )
    row.write.mode("overwrite").parquet(f"{metrics_path}/run_id={run_id}")
    return spark.read.option("basePath", metrics_path).parquet(metrics_path)
