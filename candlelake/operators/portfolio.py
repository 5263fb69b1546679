"""Portfolio series, summary, backtest and diversification.

``portfolio_type`` is a grouping column in every operator, so any number of
portfolios is evaluated in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlelake.functions import diversification_label, divide_or, running_product

# The three weight thresholds in use.
ACTIVE_WEIGHT = 1e-6  # counts as an active asset
HELD_WEIGHT = 1e-12  # enters the effective number of holdings
STORED_WEIGHT = 1e-8  # is written to the weights table

# Shares of correlation and concentration in the score.
CORRELATION_SHARE = 0.8
HOLDINGS_SHARE = 0.2


def dense_weights(universe: DataFrame, sparse: DataFrame, portfolio_type: str) -> DataFrame:
    """One weight per universe symbol, 0 where the portfolio names none.

    A portfolio symbol outside the universe is dropped, so the weights may sum
    to less than 1.
    """
    mine = sparse.where(F.col("portfolio_type") == portfolio_type).select("symbol", "weight")
    return universe.join(mine, "symbol", "left").select(
        F.lit(portfolio_type).alias("portfolio_type"),
        "symbol",
        "ord",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
    )


def single_asset_weights(universe: DataFrame, symbol: str, portfolio_type: str) -> DataFrame:
    """The whole portfolio in one symbol, as dense weights."""
    return universe.select(
        F.lit(portfolio_type).alias("portfolio_type"),
        "symbol",
        "ord",
        F.when(F.col("symbol") == symbol, 1.0).otherwise(0.0).alias("weight"),
    )


def portfolio_returns(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted return per portfolio and date.

    Only held symbols are joined; a portfolio that holds nothing keeps one symbol of weight 0, so that it
    still has a return of 0 on every date.
    """
    held = weights.where(F.col("weight") != 0).select("portfolio_type", "symbol", "weight")
    idle = (
        weights.groupBy("portfolio_type")
        .agg(F.min("symbol").alias("symbol"), F.max(F.abs("weight")).alias("weight"))
        .where(F.col("weight") == 0)
    )
    return (
        returns.select("symbol", "date", "ret")
        .join(held.unionByName(idle), "symbol")
        .groupBy("portfolio_type", "date")
        .agg(F.sum(F.col("weight") * F.col("ret")).alias("ret"))
    )


def annualised_return(mean: Column, periods: int) -> Column:
    return F.pow(1 + mean, F.lit(float(periods))) - 1


def summarize(series: DataFrame, capital: float, risk_free: float, periods: int) -> DataFrame:
    """Return, risk, Sharpe ratio and final value of every portfolio."""
    base = series.groupBy("portfolio_type").agg(
        F.max("date").alias("as_of_date"),
        F.avg("ret").alias("avg_daily_return"),
        F.coalesce(F.stddev_samp("ret"), F.lit(0.0)).alias("portfolio_volatility"),
        (F.product(1 + F.col("ret")) * capital).alias("ending_value"),
    )
    return (
        base.withColumn("annualized_return", annualised_return(F.col("avg_daily_return"), periods))
        .withColumn("annualized_volatility", F.col("portfolio_volatility") * F.sqrt(F.lit(periods)))
        .withColumn(
            "sharpe_ratio",
            divide_or(F.col("annualized_return") - risk_free, F.col("annualized_volatility")),
        )
        .withColumn("pct_gain", F.col("ending_value") / capital - 1)
    )


def backtest(series: DataFrame, capital: float) -> DataFrame:
    """Value path, cumulative return and drawdown of every portfolio.

    One portfolio's path is sequential by nature; it has at most ``lookback``
    rows, and portfolios run in parallel.
    """
    so_far = (
        W.partitionBy("portfolio_type").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    )
    valued = series.withColumn(
        "portfolio_value", F.product(1 + F.col("ret")).over(so_far) * capital
    )
    # the peak starts at the initial capital
    peak = F.greatest(F.lit(float(capital)), F.max("portfolio_value").over(so_far))
    return valued.withColumn("peak", peak).select(
        "portfolio_type",
        "date",
        "portfolio_value",
        (F.col("portfolio_value") / capital - 1).alias("cumulative_return"),
        F.col("ret").alias("daily_return"),
        F.when(F.col("peak") != 0, F.col("portfolio_value") / F.col("peak") - 1)
        .otherwise(0.0)
        .alias("drawdown"),
    )


def value_paths(
    returns: DataFrame, capital: float, chunk: Column, key: str = "symbol", order: str = "timestamp", ret: str = "ret"
) -> DataFrame:
    """``portfolio_value, peak, cumulative_return, drawdown`` after every return of a series of any length.

    As ``backtest``, for series that no task could hold: chunks are walked apart and linked by ``running_product``. The peak starts at the
    initial capital; a null return leaves the value as it is.
    """
    walked = running_product(returns, key, order, 1 + F.col(ret), chunk)
    value, peak = F.col("product") * capital, F.greatest(F.lit(1.0), "peak") * capital
    return walked.select(
        *returns.columns,
        value.alias("portfolio_value"),
        peak.alias("peak"),
        (F.col("product") - 1).alias("cumulative_return"),
        F.when(peak != 0, value / peak - 1).otherwise(0.0).alias("drawdown"),
    )


def with_benchmark_value(paths: DataFrame, benchmark: str = "benchmark") -> DataFrame:
    """Value of the benchmark on the same date; null on the benchmark's own rows.

    The benchmark's rows, one a date, are joined to all others, whatever their number.
    """
    is_benchmark = F.col("portfolio_type") == benchmark
    values = paths.where(is_benchmark).select("date", F.col("portfolio_value").alias("_value"))
    return paths.join(values, "date", "left").select(
        *paths.columns, F.when(~is_benchmark, F.col("_value")).alias("benchmark_value")
    )


def pair_moments(pairs: DataFrame, key: str) -> DataFrame:
    """Sums over held pairs ``i <= j`` from which risk and score follow.

    ``pairs`` has ``weight_x``, ``weight_y`` and the matrix columns. All sums
    come from one aggregation.
    """
    wx, wy = F.col("weight_x"), F.col("weight_y")
    same = F.col("ord_x") == F.col("ord_y")
    active = ~same & (wx > ACTIVE_WEIGHT) & (wy > ACTIVE_WEIGHT)
    product = wx * wy
    return pairs.groupBy(key).agg(
        F.sum(F.when(same, wx * F.col("mean_return_x"))).alias("mean_return"),
        F.sum(F.when(same, product).otherwise(2 * product) * F.col("covariance")).alias("variance"),
        F.count_if(same & (wx > ACTIVE_WEIGHT)).alias("n_active"),
        F.sum(F.when(same & (wx > HELD_WEIGHT), product)).alias("sum_squares"),
        F.sum(F.when(active, product).otherwise(0.0)).alias("pair_weight"),
        F.sum(F.when(active, product * F.abs("correlation")).otherwise(0.0)).alias("pair_correlation"),
    )


def score_columns(moments: DataFrame) -> DataFrame:
    """Average absolute correlation, effective holdings and the score in [0, 1]."""
    average = divide_or(F.col("pair_correlation"), F.col("pair_weight"), 1.0)
    effective = divide_or(F.lit(1.0), F.col("sum_squares"))
    share = F.least(F.lit(1.0), F.col("effective_holdings") / F.col("n_active"))
    raw = CORRELATION_SHARE * (1 - F.col("avg_abs_correlation")) + HOLDINGS_SHARE * share
    score = F.when(F.col("n_active") > 1, F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))
    return (
        moments.withColumn("avg_abs_correlation", average)
        .withColumn("effective_holdings", effective)
        .withColumn("diversification_score", score.otherwise(0.0))
    )


def diversification(weights: DataFrame, upper: DataFrame) -> DataFrame:
    """Score and label of every portfolio.

    Forms the pairs of symbols that a portfolio holds and looks their matrix cells up, so
    the rows are the held pairs and not cells times holders. What weights alone decide does not need the matrix.
    """
    held = weights.where(F.col("weight") > ACTIVE_WEIGHT)
    x = held.select("portfolio_type", F.col("ord").alias("ord_x"), F.col("weight").alias("weight_x"))
    y = held.select("portfolio_type", F.col("ord").alias("ord_y"), F.col("weight").alias("weight_y"))
    pairs = x.join(y, "portfolio_type").where(F.col("ord_x") < F.col("ord_y"))
    product = F.col("weight_x") * F.col("weight_y")
    found = (
        pairs.join(upper.select("ord_x", "ord_y", "correlation"), ["ord_x", "ord_y"])
        .groupBy("portfolio_type")
        .agg(F.sum(product).alias("pair_weight"), F.sum(product * F.abs("correlation")).alias("pair_correlation"))
    )
    own = weights.groupBy("portfolio_type").agg(
        F.count_if(F.col("weight") > ACTIVE_WEIGHT).alias("n_active"),
        F.sum(F.when(F.col("weight") > HELD_WEIGHT, F.col("weight") * F.col("weight"))).alias("sum_squares"),
    )
    zero = F.lit(0.0)
    moments = own.join(found, "portfolio_type", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("pair_weight", "pair_correlation", "sum_squares")}
    )
    return score_columns(moments).select(
        "portfolio_type",
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce("avg_abs_correlation", F.lit(1.0)).alias("avg_abs_correlation"),
        F.coalesce("effective_holdings", F.lit(0.0)).alias("effective_holdings"),
        F.coalesce("diversification_score", F.lit(0.0)).alias("diversification_score"),
    ).withColumn("diversification_label", diversification_label(F.col("diversification_score")))


def ranked_weights(weights: DataFrame) -> DataFrame:
    """Stored weights with their rank by size; equal weights keep universe order."""
    order = W.partitionBy("portfolio_type").orderBy(F.desc("weight"), "ord")
    return weights.where(F.col("weight") > STORED_WEIGHT).withColumn(
        "weight_rank", F.row_number().over(order)
    )
