"""Stage boundaries and small frame helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.session import work_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# id that stands in for a null document id inside an operator; it sorts first
NULL_ID = -(2**63)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stage(df: DataFrame, name: str, small: bool = False, arrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The stored table survives lost executors and cuts the lineage. Shuffle files
    of the job that wrote it are of no further use, so Spark may drop them. A ``small`` table, of
    a few numbers a row, is written by an eighth of the tasks: starting files would cost more than filling them. ``arrow_rows`` bounds the rows of
    whole texts that a Python worker gets at a time.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    settings = {CLEANUP: "true", **({ARROW_ROWS: str(arrow_rows)} if arrow_rows else {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        (df.coalesce(max(12, parts(spark) // 8)) if small else df).write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def drop(*stages: DataFrame) -> None:
    """Delete staged tables whose readers have all run."""
    for df in stages:
        for file in df.inputFiles()[:1]:
            folder = file.rsplit("/", 1)[0]
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed_docs(docs: DataFrame, *more: str) -> DataFrame:
    """``did, th, text``: id (null: NULL_ID), a short hash of the text and the text (null: empty); and columns ``more``.

    ``did, th`` tells apart most rows that share an id but not the text; ``told_apart`` and ``numbered`` tell apart all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"),
        F.hash(text).alias("th"),
        text.alias("text"),
        *more,
    )


def told_apart(keyed: DataFrame) -> DataFrame:
    """``keyed_docs`` with the id as ``id``, and as ``did`` a 64-bit hash of id and text: with ``th``, 96 bits for each row."""
    return keyed.withColumnRenamed("did", "id").withColumn("did", F.xxhash64("id", "text"))


def numbered(keyed: DataFrame) -> DataFrame:
    """``keyed_docs`` with a ``th`` that differs between rows that share an id, but not the text, for certain.

    Nothing changes if no id repeats, which takes a look at the ids alone. Otherwise the distinct rows are numbered in the order of id and hash of the text,
    over all tasks, and ``th`` is that number in 32 bits: neither nulls nor any id, however often it repeats, meet in one place.
    """
    if keyed.groupBy("did").count().where("count > 1").isEmpty():
        return keyed
    wide = keyed.drop("th").withColumn("wide", F.xxhash64("text"))
    rows = wide.select("did", "wide").distinct().repartitionByRange(parts(keyed.sparkSession), "did", "wide")
    marked = rows.sortWithinPartitions("did", "wide").withColumn("mark", F.monotonically_increasing_id())
    # a mark holds the number of the task above that of the row
    told = stage(marked.select("did", "wide", F.shiftright("mark", 33).alias("part"), F.col("mark").bitwiseAND((1 << 33) - 1).alias("own")), "numbers", small=True)
    bases = F.broadcast(starts_of_parts(told.withColumn("one", F.lit(1)), "part", "one"))
    low = (F.col("base") + F.col("own")).bitwiseAND((1 << 32) - 1)
    signed = F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low).cast("int")
    return wide.join(told.join(bases, "part").select("did", "wide", signed.alias("th")), ["did", "wide"]).drop("wide")


def doc_id(column: str = "did"):
    return F.when(F.col(column) != NULL_ID, F.col(column))


def give_back() -> None:
    """Return what a worker has freed to the system: workers outlive their tasks, and share an executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(function):
    """A function of a partition's batches that gives memory back after the last one."""

    def run(batches):
        yield from function(batches)
        give_back()

    return run


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a function of one Arrow batch; it may yield any number of batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(giving_back(run), schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs_of_rows(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


# groups of at least this share of all rows meet their members by broadcast
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """``rows.join(groups, key)`` for groups of ``size`` rows each, of ``total`` rows in all; both are stored tables.

    Groups of at least a thousandth of all rows, of which there are at most a thousand, are broadcast, so that their members stay where they are; the
    others are joined by key, and none of them is large.
    """
    limit = max(2, total // HOT_SHARE)
    hot, cold = F.broadcast(groups.where(F.col(size) >= limit)), groups.where(F.col(size) < limit)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(rest)


def starts_of_parts(df: DataFrame, part: str, size: str) -> DataFrame:
    """``part, base``: the sum of ``size`` over all smaller parts.

    ``part`` numbers the tasks of a stage, so the table has a row per task.
    """
    totals = df.groupBy(part).agg(F.sum(size).alias("_size"))
    sums = totals.select(
        part,
        F.sum("_size").over(_before(part)).alias("base"),
    )
    return sums.select(part, F.coalesce("base", F.lit(0)).cast("long").alias("base"))


def _before(part: str):
    from pyspark.sql import Window

    return Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
