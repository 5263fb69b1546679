"""File sources: CSV archives, Parquet lakes and JSON lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.schemas import CANDLE_COLUMNS, CSV_ARCHIVE_SCHEMA, DOUBLE_COLUMNS

# Name of the folder that holds a file; accepts both ".../BTC/x" and ".../ticker=BTC/x".
FOLDER_OF_FILE = r"/(?:[^/=]+=)?([^/]+)/[^/]+$"


def read_csv_archive(
    spark: SparkSession,
    paths: str | Sequence[str],
    exclude: Iterable[str] = (),
    symbol_pattern: str = FOLDER_OF_FILE,
) -> DataFrame:
    """Candles from CSV files with a header, one folder per ticker.

    The schema is given, so no pass over the data infers it; the symbol is
    group 1 of ``symbol_pattern`` in the file path.
    """
    raw = (
        spark.read.schema(CSV_ARCHIVE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .csv(paths if isinstance(paths, str) else list(paths), header=True)
    )
    symbols = raw.drop("ignore").withColumn(
        "symbol", F.regexp_extract(F.col("_metadata.file_path"), symbol_pattern, 1)
    )
    excluded = list(exclude)
    if excluded:
        symbols = symbols.where(~F.col("symbol").isin(excluded))
    return symbols.select(CANDLE_COLUMNS)


def read_partitioned(
    spark: SparkSession, base: str, paths: Sequence[str] | None = None
) -> DataFrame:
    """Candles from a Parquet lake laid out as ``symbol=<S>/date=<D>/``.

    ``basePath`` keeps the partition columns when only some folders are named.
    A predicate on ``symbol`` or ``date`` prunes folders before any file opens. Folder names are
    read as text, so a symbol such as ``007`` stays as it is.
    """
    reader = spark.read.option("basePath", base)
    raw = _named(reader, reader.parquet(*(paths or [base])).schema).parquet(*(paths or [base]))
    return to_canonical(raw, keep=["date"] if "date" in raw.columns else [])


def read_universe(spark: SparkSession, base: str, universe: DataFrame) -> DataFrame:
    """Candles of the symbols of ``universe`` from a lake laid out as ``symbol=<S>/date=<D>/``; folders of other symbols are never opened.

    The universe is known only when the job runs, so folders are pruned then, by the symbols that the join broadcasts.
    """
    # a bound on the symbol lets the optimizer expect that the universe leaves some out
    members = universe.select("symbol").where(F.length("symbol") > 0)
    return read_partitioned(spark, base).join(members, "symbol", "left_semi")


def read_day(spark: SparkSession, base: str, day: str | dt.date) -> DataFrame:
    """Candles of one date partition, selected by partition pruning."""
    lake = _named(spark.read, spark.read.parquet(base).schema).parquet(base)
    return to_canonical(lake.where(F.col("date") == F.lit(str(day)).cast("date")))


def read_daily_folder(spark: SparkSession, base: str, day: str | dt.date) -> DataFrame:
    """Candles of one day from the layout ``<D>/data.parquet``, where the symbol is a column."""
    return to_canonical(spark.read.parquet(f"{base}/{day}/data.parquet"))


def _named(reader, found: T.StructType):
    """The reader with the columns found, but symbols as text and dates as dates."""
    fixed = {"symbol": T.StringType(), "date": T.DateType()}
    return reader.schema(T.StructType([T.StructField(f.name, fixed.get(f.name, f.dataType)) for f in found]))


def to_canonical(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical column order with the eight numeric columns as double."""
    return raw.select(
        *[
            F.col(c).cast(T.DoubleType()).alias(c) if c in DOUBLE_COLUMNS else F.col(c)
            for c in CANDLE_COLUMNS
        ],
        *keep,
    )


def file_row_counts(lake: DataFrame) -> DataFrame:
    """Rows held by each file of a file-backed frame."""
    return lake.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def partition_stats(lake: DataFrame, partition: str = "date") -> DataFrame:
    """Rows, distinct symbols and files of every partition.

    One row per (partition, file, symbol) is left after the first aggregation,
    so the two distinct counts run on that small table and not on the candles.
    """
    per_symbol = lake.groupBy(
        partition, F.col("_metadata.file_path").alias("file"), "symbol"
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_symbol.groupBy(partition).agg(
        F.sum("n").alias("n_rows"),
        F.countDistinct("symbol").alias("n_symbols"),
        F.countDistinct("file").alias("n_files"),
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose Parquet reader answers counts, least and greatest values from file footers."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    # the reader that can do so is used for formats that are not on this list
    kept = [name for name in other.conf.get("spark.sql.sources.useV1SourceList").split(",") if name.strip() != "parquet"]
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``n_rows`` and ``min_c, max_c`` of each column ``c``, per value of the partition columns ``by``, without reading a row group.

    Footers hold bounds of whole numbers, dates and doubles; times have to be stored as numbers. A row group whose column is wholly null or
    holds a NaN has none: bounds of such a column fail with the name of the file, while counts never do. Rows that a filter would have to look
    at can't be answered from footers, so there is none.
    """
    lake = footer_session(spark).read.parquet(path)
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return lake.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(
        paths if isinstance(paths, str) else list(paths)
    )
