"""Registered queries of the operators and the pipeline, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm import (
    bisectors,
    exact_copies,
    importance,
    langid,
    licenses,
    mixing,
    packing,
    simhash,
    substring_automaton,
    suffix_array,
    syncmers,
    tokens,
    vectors,
)
from candlelake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# shares of the tokens by domain, and the probability under which a language counts as unrecognised
TARGETS = {"good": 0.85, "poor": 0.1, "toxic": 0.05}
LEAST_SCORE = 0.35

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(use_utc(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_automaton.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


ORACLES["op1_substring_dedup"] = substring_automaton.oracle()


@query
def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_file_report(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op6_license_scan"] = licenses.oracle()


@query
def op6_license_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.statements(table(spark, sf_dir, "documents"))


ORACLES["op6_license_statements"] = licenses.statements_oracle()


@query
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return vectors.search_lengths(found, F.expr("vec_id % 20 = 0")).drop("query_variant", "variant")


@query
def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY).drop("ids")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS)


@query
def op11_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.groups(table(spark, sf_dir, "documents"), digests=True)


ORACLES["op11_exact_copies"] = exact_copies.oracle()


@query
def op12_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.report(table(spark, sf_dir, "embeddings"))


ORACLES["op12_bisector_clusters"] = bisectors.oracle()


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_importance"] = importance.oracle()
