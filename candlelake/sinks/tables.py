"""Partitioned Parquet sinks and table maintenance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    sort: Sequence[str] = ("symbol", "timestamp"),
    dynamic: bool = False,
) -> None:
    """Write Parquet folders ``by``, Snappy-compressed.

    ``rebalance`` gathers each partition value so that it becomes a few files
    of the advisory size instead of one file per upstream task; a value that
    holds far more rows than others is split over several tasks. Sorting gives
    row groups narrow symbol and time bounds.
    """
    order = [*by, *[c for c in sort if c in df.columns]]
    writer = (
        df.hint("rebalance", *[F.col(c) for c in by])
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(*by)
    )
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_by_date(df: DataFrame, path: str, mode: str = "overwrite", ts: str = "timestamp") -> None:
    """Add ``date`` from the candle's own time and write one folder per date."""
    write_partitioned(df.withColumn("date", F.to_date(ts)), path, ["date"], mode)


def write_daily_folder(df: DataFrame, base: str, day: str | dt.date) -> None:
    """Candles of one day as ``<D>/data.parquet``: a folder of that name, the symbol a column; a rerun replaces it."""
    rows = df.where(F.to_date("timestamp") == F.lit(str(day)).cast("date"))
    rows.hint("rebalance").sortWithinPartitions("symbol", "timestamp").write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(f"{base}/{day}/data.parquet")


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], scope: Sequence[str] = ()) -> None:
    """Replace the partitions present in ``df``; the rest stays as it is.

    ``scope`` names folders of the first partition column that are replaced in any case: those for which ``df`` has no rows are
    deleted once the new rows are in place. ``df`` is computed once; which folders it filled is read back from
    their files, whose names are new.
    """
    spark = df.sparkSession
    before = {name: _files(spark, path, name) for name in scope}
    write_partitioned(df, path, by, dynamic=True)
    _delete_folders(spark, path, [name for name, old in before.items() if not _files(spark, path, name) - old])


def _files(spark: SparkSession, path: str, name: str) -> set[str]:
    """Parquet files of a partition folder, at any depth."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path, name)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return set()
    found, files = set(), fs.listFiles(folder, True)
    while files.hasNext():
        file = files.next().getPath().toString()
        if file.endswith(".parquet"):
            found.add(file)
    return found


def _delete_folders(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)


def delete_folders(spark: SparkSession, path: str, keep: Sequence[str]) -> None:
    """Delete the partition folders directly below ``path`` but those named in ``keep``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(root):
        names = [status.getPath().getName() for status in fs.listStatus(root) if status.isDirectory()]
        _delete_folders(spark, path, [name for name in names if "=" in name and name not in keep])


def existing_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Dates of the ``date=`` folders below ``path`` that hold a Parquet file.

    No file is opened, and there is one entry per calendar date. A folder that a failed job left
    empty doesn't count.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    files = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "date=????-??-??/*.parquet"))
    names = {status.getPath().getParent().getName() for status in files}
    return sorted(dt.date.fromisoformat(name.partition("=")[2]) for name in names)


def append_missing_dates(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Append only dates the target does not hold yet, so a rerun adds nothing."""
    dated = df.withColumn("date", F.to_date(ts))
    present = existing_dates(df.sparkSession, path)
    if present:
        dated = dated.where(~F.col("date").isin(present))
    write_partitioned(dated, path, ["date"], mode="append")


def with_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Month partition value as ``yyyyMM``."""
    return df.withColumn("month", F.date_format(date, "yyyyMM"))


def register_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, by: Sequence[str]
) -> DataFrame:
    """Create or update an external partitioned Parquet table over ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def add_missing_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of an older and a newer table version; absent columns become null."""
    return old.unionByName(new, allowMissingColumns=True)


def load_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a load, and the difference."""
    counts = after.agg(F.count(F.lit(1)).alias("rows_after"))
    rows_before = before.agg(F.count(F.lit(1))).scalar()
    return counts.select(rows_before.alias("rows_before"), "rows_after").withColumn(
        "rows_loaded", F.col("rows_after") - F.col("rows_before")
    )
