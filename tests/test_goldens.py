"""Worked examples with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlelake.functions import diversification_label
from candlelake.operators import panel, portfolio


def _days(*values):
    return [(dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]


def test_simple_return(spark):
    rows = [("A", 0, d, c) for d, c in _days(100.0, 105.0)]
    closes = spark.createDataFrame(rows, "symbol string, ord int, date date, close double")
    got = panel.asset_returns(closes).collect()
    assert [r.ret for r in got] == [pytest.approx(0.05)]


def test_weighted_return(spark):
    day = dt.date(2024, 1, 2)
    returns = spark.createDataFrame(
        [("A", 0, day, 0.02), ("B", 1, day, -0.01)], "symbol string, ord int, date date, ret double"
    )
    weights = spark.createDataFrame(
        [("p", "A", 0.5), ("p", "B", 0.5)], "portfolio_type string, symbol string, weight double"
    )
    assert portfolio.portfolio_returns(returns, weights).first().ret == pytest.approx(0.005)


def test_value_path_and_drawdown(spark):
    series = spark.createDataFrame(
        [("p", d, r) for d, r in _days(0.02, -0.01)], "portfolio_type string, date date, ret double"
    )
    rows = portfolio.backtest(series, 10_000.0).orderBy("date").collect()
    assert [r.portfolio_value for r in rows] == pytest.approx([10_200.0, 10_098.0])
    assert [r.drawdown for r in rows] == pytest.approx([0.0, 10_098 / 10_200 - 1])


def test_drawdown_counts_from_the_initial_capital(spark):
    series = spark.createDataFrame(
        [("p", d, r) for d, r in _days(-0.1, 0.05, -1.0)], "portfolio_type string, date date, ret double"
    )
    rows = portfolio.backtest(series, 100.0).orderBy("date").collect()
    assert [r.drawdown for r in rows] == pytest.approx([-0.1, -0.055, -1.0])
    assert rows[-1].portfolio_value == 0.0


def test_cumulative_return_and_gain(spark):
    series = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 0.25), ("b", dt.date(2024, 1, 1), 2.154735)],
        "portfolio_type string, date date, ret double",
    )
    path = {r.portfolio_type: r for r in portfolio.backtest(series, 10_000.0).collect()}
    assert path["a"].cumulative_return == pytest.approx(0.25)
    gains = {r.portfolio_type: r for r in portfolio.summarize(series, 10_000.0, 0.0, 252).collect()}
    assert gains["b"].ending_value == pytest.approx(31_547.35)
    assert gains["b"].pct_gain == pytest.approx(2.154735)
    # a single return has no deviation, hence no Sharpe ratio
    assert gains["b"].portfolio_volatility == 0.0
    assert gains["b"].sharpe_ratio == 0.0


def test_score_bands(spark):
    scores = [0.0, 0.349999, 0.35, 0.649999, 0.65, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    labels = [r[0] for r in df.select(diversification_label(F.col("s"))).collect()]
    assert labels == ["Low", "Low", "Medium", "Medium", "High", "High"]
