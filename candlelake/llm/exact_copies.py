"""Exact copies by progressive refinement: length, then a hash of the first characters, then a hash of the whole text.

Every level looks only at what the level before could not tell apart. Lengths and prefix hashes are 16 bytes a row;
which of them occur more than once is kept in a bit filter of at most ``FILTER_WORDS`` numbers, so its broadcast is bounded
at any size. A text that passes the filter by chance is hashed for nothing and turns out to be alone: results
never depend on the filter. Only texts that pass both filters are hashed as a whole, grouped, or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.stages import HOT_SHARE, drop, stage

# characters of the second level
PREFIX = 64
# numbers of 64 bits in a filter: the broadcast table has at most so many rows of 16 bytes
FILTER_WORDS = 1 << 20


def normalised(text: Column) -> Column:
    """The text with each run of ``[\\x20\\x09-\\x0D]`` replaced by one space; a null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _slot(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(FILTER_WORDS * 64))


def bit_filter(rows: DataFrame, *key: str) -> DataFrame:
    """``word, bits``: a filter of the keys of ``rows``."""
    bit = F.expr("shiftleft(1L, cast(slot & 63L as int))")
    slots = rows.select(_slot(*key).alias("slot"))
    return slots.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(F.bit_or(bit).alias("bits"))


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """The filter of the keys that more than one row has."""
    return bit_filter(rows.groupBy(*key).count().where("count > 1"), *key)


def passing(rows: DataFrame, filter_: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``passes``, which is false only where the key is not in the filter."""
    slotted = rows.withColumn("slot", _slot(*key)).withColumn("word", F.expr("shiftright(slot, 6)"))
    found = F.expr("shiftright(bits, cast(slot & 63L as int)) & 1L = 1L")
    joined = slotted.join(F.broadcast(filter_), "word", "left")
    return joined.withColumn("passes", F.coalesce(found, F.lit(False))).drop("slot", "word", "bits")


def _sketched(base: DataFrame) -> DataFrame:
    return base.withColumn("length", F.octet_length("text")).withColumn(
        "prefix", F.xxhash64(F.substring("text", 1, PREFIX))
    )


def _refined(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``base`` (with ``text``, normalised) with ``passes``: whether another text may be equal; and what to drop afterwards."""
    sketches = stage(_sketched(base).select("length", "prefix"), "sketches")
    alike = passing(sketches, stage(_repeated(sketches, "length"), "lengths", small=True), "length").where("passes")
    prefixes = stage(_repeated(alike, "length", "prefix"), "prefixes", small=True)
    return passing(_sketched(base), prefixes, "length", "prefix").drop("length", "prefix"), sketches


def _firsts(rows: DataFrame) -> DataFrame:
    """``digest, first, n`` of the texts that several rows have: the row that stays, and how many there are."""
    order = F.struct(F.isnull("did").alias("unnamed"), "did", "at")
    return rows.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")


def groups(docs: DataFrame, digests: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: a row per row of ``docs``.

    Rows whose normalised texts are equal form a group; the row of the least ``doc_id`` stays (null ids come last), and of rows
    that share this id too, the one that Spark reads first, so each group keeps exactly one row. Null texts are
    empty texts and equal each other. ``text_sha256`` is null for texts that never had to be read as a whole, unless ``digests``
    asks for all. Other columns play no part. An empty table gives no rows. Texts of any length are hashed whole.

    A group of any size costs one row per map task before the shuffle. Groups of at least a thousandth of all rows, of
    which there are at most a thousand, go back to their members by broadcast, the others by key.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("did"), normalised(F.col("text")).alias("text"))
    marked, sketches = _refined(base)
    digest = F.sha2("text", 256)
    sha = digest if digests else F.when(F.col("passes"), digest)
    rows = stage(marked.select("did", F.monotonically_increasing_id().alias("at"), "passes", sha.alias("digest")), "digests")
    drop(sketches)
    found = stage(_firsts(rows.where("passes")), "copies", small=True)
    limit = max(2, rows.count() // HOT_SHARE)
    hot, cold = F.broadcast(found.where(F.col("n") >= limit)), found.where(F.col("n") < limit)
    members = rows.where("passes")
    lone = rows.where("not passes").select("*", F.lit(None).cast(found.schema["first"].dataType).alias("first"), F.lit(1).cast("long").alias("n"))
    columns = ["did", "at", "digest", "first", "n"]
    # members that passed by chance are in no group, hence the left join
    all_rows = (
        lone.select(columns)
        .union(members.join(hot, "digest").select(columns))
        .union(members.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest", "left").select(columns))
    )
    alone = F.isnull("first")
    return all_rows.select(
        F.col("did").alias("doc_id"),
        F.when(alone, F.col("did")).otherwise(F.col("first.did")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("at") == F.col("first.at"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps, with all their columns, whatever their names.

    Texts that passed no filter are neither hashed nor shuffled.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    base = docs.select(row, F.col("doc_id").cast("long").alias("did"), normalised(F.col("text")).alias("text"))
    marked, sketches = _refined(base)
    lone = marked.where("not passes").select("row")
    alike = marked.where("passes").select("row", "did", F.sha2("text", 256).alias("digest"))
    rows = stage(alike.withColumn("at", F.monotonically_increasing_id()), "alike")
    leaving = rows.select("digest", "at", "did")
    first = leaving.groupBy("digest").agg(F.min(F.struct(F.isnull("did").alias("unnamed"), "did", "at")).alias("first"))
    staying = rows.join(first.select(F.col("first.at").alias("at")), "at", "left_semi").select("row")
    return lone.union(staying).select("row.*")


def oracle() -> str:
    return r"""
        WITH texts AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT
            doc_id,
            min(doc_id) OVER w AS keep_id,
            count(*) OVER w AS group_size,
            doc_id = min(doc_id) OVER w AS kept,
            text_sha256
        FROM texts
        WINDOW w AS (PARTITION BY text_sha256)
    """
