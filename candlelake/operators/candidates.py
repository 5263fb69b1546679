"""Random candidate portfolios, scored in parallel.

The draws follow the usual recipe: the number of assets is uniform over the
feasible range, the assets are a uniform subset, every asset gets the minimum
weight and the rest is split by a flat Dirichlet draw. They come from hashes of
(seed, candidate, step), so they do not depend on partitioning and a lost task
recomputes the same candidates. The numbers are not those of a sequential
generator with the same seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.functions import divide_or, hashed_uniform
from candlelake.operators.portfolio import annualised_return, pair_moments, score_columns


def feasible_range(
    n_assets: Column, min_active: int, max_active: int, min_weight: float
) -> tuple[Column, Column]:
    """Smallest and largest feasible number of assets; bad constraints raise."""
    if not 0 <= min_weight < 1:
        raise ValueError("the minimum weight must lie in [0, 1)")
    if min_active < 1:
        raise ValueError("at least one active asset is needed")
    if min_active > max_active:
        raise ValueError("the minimum number of assets exceeds the maximum")
    limit = min(max_active, int(1 / min_weight)) if min_weight > 0 else max_active
    return F.least(F.lit(min_active), n_assets), F.least(F.lit(limit), n_assets)


def candidate_legs(
    spark: SparkSession,
    n_assets: Column,
    n: int,
    seed: int,
    min_active: int,
    max_active: int,
    min_weight: float,
) -> DataFrame:
    """Candidates ``1..n`` with ``legs``: an array of (ord, weight).

    No shuffle and no join: a candidate is a function of its id. The subset is
    drawn with Floyd's method, which needs as many draws as assets chosen and
    not one per universe symbol.
    """
    low, high = feasible_range(F.col("n_assets"), min_active, max_active, min_weight)
    sim = F.col("simulation_id")
    infeasible = F.raise_error(F.lit("no feasible number of active assets")).cast("int")
    count = low + F.floor(hashed_uniform(seed, sim, F.lit("k")) * (high - low + 1)).cast("int")

    def pick(chosen: Column, j: Column) -> Column:
        drawn = F.floor(hashed_uniform(seed, sim, F.lit("a"), j) * (j + 1)).cast("int")
        fresh = F.when(F.array_contains(chosen, drawn), j).otherwise(drawn)
        return F.array_append(chosen, fresh)

    steps = F.sequence(F.col("n_assets") - F.col("k"), F.col("n_assets") - 1)
    raw = F.transform(
        F.sequence(F.lit(0), F.col("k") - 1),
        lambda i: -F.log(hashed_uniform(seed, sim, F.lit("w"), i)),
    )
    rest = F.greatest(F.lit(0.0), 1 - F.col("k") * min_weight)
    leg = lambda asset, r: F.struct(
        asset.alias("ord"), (min_weight + rest * divide_or(r, F.col("raw_total"))).alias("weight")
    )
    return (
        spark.range(1, n + 1)
        .select(F.col("id").cast("int").alias("simulation_id"), n_assets.cast("int").alias("n_assets"))
        .withColumn("k", F.when((high >= 1) & (low <= high), count).otherwise(infeasible))
        .withColumn("assets", F.aggregate(steps, F.array().cast("array<int>"), pick))
        .withColumn("raw", raw)
        .withColumn("raw_total", F.aggregate("raw", F.lit(0.0), lambda acc, r: acc + r))
        .select("simulation_id", F.zip_with("assets", "raw", leg).alias("legs"))
    )


def candidate_weights(legs: DataFrame, universe: DataFrame) -> DataFrame:
    """One row per candidate and asset."""
    return (
        legs.select("simulation_id", F.inline("legs"))
        .join(universe.select("ord", "symbol"), "ord")
        .select("simulation_id", "ord", "symbol", "weight")
    )


def _leg_pairs(legs: str) -> Column:
    """Array of the pairs of an array of legs, each pair once, a leg with itself included.

    One generator over this array is several times faster than exploding the
    legs twice, which would carry and re-evaluate the array on every row.
    """
    def pair(a: Column, b: Column) -> Column:
        return F.struct(
            F.least(a["ord"], b["ord"]).alias("ord_x"),
            F.greatest(a["ord"], b["ord"]).alias("ord_y"),
            a["weight"].alias("weight_x"),
            b["weight"].alias("weight_y"),
        )

    def with_rest(a: Column, i: Column) -> Column:
        return F.transform(F.slice(legs, i + 1, F.size(legs)), lambda b: pair(a, b))

    return F.flatten(F.transform(legs, with_rest))


def score_candidates(
    legs: DataFrame, upper: DataFrame, risk_free: float, periods: int
) -> DataFrame:
    """Annualised return and risk, Sharpe ratio and score of every candidate.

    A candidate expands to its own pairs, at most ``max_active * (max_active +
    1) / 2`` rows, next to each other in one task: the aggregation folds them
    to one row before its shuffle. The matrix is joined by key, so Spark
    broadcasts it only while its size allows that.
    """
    pairs = legs.select("simulation_id", F.inline(_leg_pairs("legs"))).join(
        upper.select("ord_x", "ord_y", "mean_return_x", "covariance", "correlation"),
        ["ord_x", "ord_y"],
    )
    scored = score_columns(pair_moments(pairs, "simulation_id"))
    volatility = F.sqrt(F.greatest(F.col("variance"), F.lit(0.0))) * F.sqrt(F.lit(periods))
    return (
        scored.withColumn("annualized_return", annualised_return(F.col("mean_return"), periods))
        .withColumn("annualized_volatility", volatility)
        .withColumn(
            "sharpe_ratio",
            divide_or(F.col("annualized_return") - risk_free, F.col("annualized_volatility")),
        )
        .select(
            "simulation_id",
            "annualized_return",
            "annualized_volatility",
            "sharpe_ratio",
            "diversification_score",
        )
    )


def best_candidate(scores: DataFrame) -> DataFrame:
    """The candidate with the greatest Sharpe ratio; of equal ones the lowest id."""
    order = F.struct(F.col("sharpe_ratio"), -F.col("simulation_id"))
    return scores.agg(F.max_by(F.struct(*scores.columns), order).alias("best")).where(
        F.col("best").isNotNull()
    ).select("best.*")


def flag_best(scores: DataFrame) -> DataFrame:
    """Scores with ``is_optimal``: 1 on the best candidate, 0 elsewhere."""
    best = best_candidate(scores).select("simulation_id").scalar()
    return scores.withColumn("is_optimal", (F.col("simulation_id") == best).cast("int"))
