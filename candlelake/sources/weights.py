"""Sparse portfolio weights written as ``SYM:w,SYM:w`` text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUM_TOLERANCE = 1e-9


def _symbol(item: Column | str) -> Column:
    return F.upper(F.trim(F.split_part(item, F.lit(":"), F.lit(1))))


def _weight(item: Column | str) -> Column:
    return F.trim(F.split_part(item, F.lit(":"), F.lit(2))).try_cast("double")


def _is_bad(symbol: Column, weight: Column) -> Column:
    return (symbol == "") | weight.isNull() | F.isnan(weight) | (weight < 0)


def _is_valid(total: Column, n_bad: Column) -> Column:
    return F.coalesce((n_bad == 0) & (F.abs(total - 1) <= SUM_TOLERANCE), F.lit(False))


def parse_weight_strings(df: DataFrame, portfolio: str, text: str) -> DataFrame:
    """Rows ``(portfolio_type, position, symbol, weight)`` from weight strings."""
    items = df.select(
        F.col(portfolio).alias("portfolio_type"),
        F.posexplode(F.split(text, ",")).alias("position", "item"),
    )
    return items.select("portfolio_type", "position", _symbol("item").alias("symbol"), _weight("item").alias("weight"))


def weight_string_checks(parsed: DataFrame) -> DataFrame:
    """One row per portfolio: weight total and whether the string is acceptable.

    A string is rejected for an empty symbol, a weight that is negative or not
    a number, or a total that differs from 1 by more than 1e-9.
    """
    bad = _is_bad(F.col("symbol"), F.col("weight"))
    totals = parsed.groupBy("portfolio_type").agg(
        F.sum("weight").alias("total_weight"), F.count_if(bad).alias("n_bad_items")
    )
    return totals.withColumn("is_valid", _is_valid(F.col("total_weight"), F.col("n_bad_items")).cast("int"))


def normalise_weights(parsed: DataFrame) -> DataFrame:
    """One weight per (portfolio, symbol); of repeated symbols the last one counts."""
    return parsed.groupBy("portfolio_type", "symbol").agg(
        F.max_by("weight", "position").alias("weight")
    )


def weights_from_string(spark: SparkSession, portfolio_type: str, text: str) -> DataFrame:
    """Weights of one portfolio from a configuration value; a bad value fails when the weights are read.

    The check reads the items as one array beside them, so neither a join nor a second pass is planned.
    """
    item = lambda x, i: F.struct(_symbol(x).alias("symbol"), _weight(x).alias("weight"), i.alias("position"))
    row = spark.range(1).select(F.transform(F.split(F.lit(text), ","), item).alias("items"))
    checked = row.select(
        "items",
        F.aggregate("items", F.lit(0.0), lambda s, x: s + F.coalesce(x["weight"], F.lit(0.0))).alias("total"),
        F.size(F.filter("items", lambda x: _is_bad(x["symbol"], x["weight"]))).alias("n_bad"),
    )
    reason = F.format_string(
        f"weight string of {portfolio_type} rejected: %d bad items, total %s", "n_bad", F.col("total").cast("string")
    )
    valid = _is_valid(F.col("total"), F.col("n_bad"))
    usable = F.when(valid, F.col("items")).otherwise(F.raise_error(reason).cast(checked.schema["items"].dataType))
    parsed = checked.select(F.lit(portfolio_type).alias("portfolio_type"), F.inline(usable))
    return normalise_weights(parsed)
