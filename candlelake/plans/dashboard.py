"""Questions a dashboard asks of the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _of(table: DataFrame, scenario_id: str) -> DataFrame:
    """Rows of one scenario: its folder only, if the table is stored."""
    return table.where(F.col("scenario_id") == scenario_id)


def allocation(weights: DataFrame, scenario_id: str, portfolio_type: str) -> DataFrame:
    """Holdings of one portfolio, largest first."""
    return (
        _of(weights, scenario_id).where(F.col("portfolio_type") == portfolio_type)
        .select("symbol", "weight", "weight_rank", "simulation_id")
        .orderBy("weight_rank")
    )


def kpis(metrics: DataFrame, scenario_id: str) -> DataFrame:
    """Headline figures per portfolio."""
    return _of(metrics, scenario_id).select(
        "portfolio_type",
        "sharpe_ratio",
        "avg_daily_return",
        "annualized_volatility",
        "diversification_label",
        "diversification_score",
        "ending_value",
        "pct_gain",
    )


def value_path(series: DataFrame, scenario_id: str, portfolios: Sequence[str]) -> DataFrame:
    """One value column per portfolio by date; naming them avoids a job to find them."""
    return _of(series, scenario_id).groupBy("date").pivot("portfolio_type", list(portfolios)).agg(
        F.first("portfolio_value")
    )


def correlation_subset(matrix: DataFrame, weights: DataFrame, scenario_id: str, always: Sequence[str]) -> DataFrame:
    """Matrix cells between the optimized holdings and the named symbols."""
    matrix = _of(matrix, scenario_id)
    held = _of(weights, scenario_id).where(F.col("portfolio_type") == "optimized").select("symbol")
    named = held.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, always))).alias("symbol"))
    wanted = held.unionByName(named).distinct()
    x = wanted.withColumnRenamed("symbol", "symbol_x")
    y = wanted.withColumnRenamed("symbol", "symbol_y")
    return matrix.join(x, "symbol_x", "left_semi").join(y, "symbol_y", "left_semi").select(
        "symbol_x", "symbol_y", "correlation"
    )


def search_space(simulations: DataFrame, scenario_id: str) -> DataFrame:
    """Risk and return of all candidates with the best one flagged."""
    return _of(simulations, scenario_id).select(
        "simulation_id", "annualized_volatility", "annualized_return", "sharpe_ratio", "is_optimal"
    )
