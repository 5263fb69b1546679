"""The corpus pipeline: stages over ``documents``, each calling one operator of ``candlelake.llm``.

All stages but the last return the columns of ``documents``. What each decides takes effect:

* language ID drops documents without a recognised language;
* SimHash near-dedup keeps one document of each group of near copies (five-word shingles, Jaccard index 0.8);
* suffix-array dedup cuts byte strings that repeat out of all texts;
* mixing drops or repeats documents so that domains reach their shares of tokens;
* packing cuts what is left into sequences of ids.

Every stage takes and keeps any table with the columns of ``documents``, whatever other columns it has. Null ids and rows that repeat an id stay rows
of their own; null and empty texts are rejected by language ID, and count as empty in the other stages; an empty table stays empty. Texts of any
length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlelake.llm import langid, mixing, near_copies, suffix_array
from candlelake.llm.packing import pack
from candlelake.llm.queries import LEAST_SCORE, TARGETS, VOCABULARY
from candlelake.llm.stages import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a recognised language. The classifier learns from the labelled rows of ``docs`` itself; without any, no row is recognised."""
    return langid.keep_identified(docs, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the least id, null ids last. Texts without words are one group."""
    return near_copies.keep_one(docs)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without strings of 200 bytes that occur anywhere else; ``n_chars`` is counted anew. A null text stays null."""
    return suffix_array.cut_repeats(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their copies; rows that repeat id and text draw alike. Empty texts have no tokens and the prior as posteriors."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TARGETS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence; null and empty texts are the end id alone, repeated rows are packed one by one."""
    return pack(docs, VOCABULARY).drop("ids")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_dedup),
    ("mixing to target weights", mixing_to_targets),
    ("packing", packing),
]

# learned classifiers, fingerprints of shingles and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
