"""Alignment, moments, candidates and scores against plain Python."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.operators import candidates, panel, portfolio, risk
from candlelake.plans.scenario import Scenario, ScenarioConfig, run_scenario

D0 = dt.date(2024, 1, 1)


def closes_frame(spark, prices):
    rows = [(s, D0 + dt.timedelta(days=d), float(c)) for s, series in prices.items() for d, c in series.items()]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def universe_frame(spark, symbols):
    return spark.createDataFrame([(s, i) for i, s in enumerate(symbols)], "symbol string, ord int")


def random_prices(symbols, days, seed=0, holes=0.0):
    rng = random.Random(seed)
    return {
        s: {d: rng.uniform(50, 150) for d in range(days) if rng.random() >= holes} for s in symbols
    }


def days_of(df):
    return sorted({(r.date - D0).days for r in df.select("date").collect()})


def test_alignment_keeps_common_dates_only(spark):
    prices = random_prices("ABC", 60, seed=1, holes=0.2)
    common = sorted(set.intersection(*(set(v) for v in prices.values())))
    got = panel.aligned_panel(closes_frame(spark, prices), universe_frame(spark, "ABC"), 10, 5)
    assert days_of(got) == common[-11:]
    assert got.count() == 33


def test_symbols_outside_the_universe_do_not_matter(spark):
    prices = {**random_prices("AB", 20, seed=2), "Z": {3: 1.0}}
    got = panel.aligned_panel(closes_frame(spark, prices), universe_frame(spark, "AB"), 50, 5)
    assert days_of(got) == list(range(20))


@pytest.mark.parametrize("missing, n_dates", [([], 10), (["Q"], 0)])
def test_short_history_and_missing_symbols(spark, missing, n_dates):
    closes = closes_frame(spark, random_prices("AB", 10, seed=3))
    universe = universe_frame(spark, ["A", "B", *missing])
    assert len(days_of(panel.aligned_panel(closes, universe, 50, 9))) == n_dates
    short = panel.aligned_panel(closes, universe, 50, 10)
    assert short.count() == 0
    with pytest.raises(Exception, match="at least 11 common dates, got 0"):
        panel.require_history(short, 10).collect()


def test_history_check_passes_a_long_panel(spark):
    closes = closes_frame(spark, random_prices("AB", 12, seed=3))
    got = panel.aligned_panel(closes, universe_frame(spark, "AB"), 50, 10)
    assert panel.require_history(got, 10).count() == 24


def test_fallback_to_full_history(spark):
    # B is absent from the last 20 days but one, so the recent window is short
    prices = random_prices("AB", 100, seed=4)
    for d in range(80, 99):
        del prices["B"][d]
    closes, universe = closes_frame(spark, prices), universe_frame(spark, "AB")
    recent = panel.panel_with_fallback(closes, universe, lookback=10, buffer=5, min_history=3)
    assert days_of(recent) == [*range(70, 80), 99]
    enough = panel.panel_with_fallback(closes, universe, lookback=30, buffer=5, min_history=10)
    # the window [64, 99] has 17 common dates, enough, so older dates are not used
    assert days_of(enough) == [*range(64, 80), 99]


def test_bad_price_fails_or_is_null(spark):
    closes = closes_frame(spark, {"A": {0: 1.0, 1: 0.0, 2: 3.0}})
    aligned = panel.aligned_panel(closes, universe_frame(spark, "A"), 10, 1)
    with pytest.raises(Exception, match="not positive"):
        panel.asset_returns(aligned).collect()
    soft = panel.asset_returns(aligned, fail_on_bad_price=False).orderBy("date").collect()
    assert [r.ret for r in soft] == [-1.0, None]


def returns_frame(spark, matrix, symbols):
    rows = [
        (s, i, D0 + dt.timedelta(days=d), float(matrix[d, i]))
        for d in range(matrix.shape[0])
        for i, s in enumerate(symbols)
    ]
    return spark.createDataFrame(rows, "symbol string, ord int, date date, ret double")


@pytest.mark.parametrize("per_block", [200, 4, 1])
def test_matrix_against_numpy(spark, per_block):
    symbols = [f"S{i:02d}" for i in range(11)]
    data = np.random.default_rng(5).normal(0, 0.02, (40, 11))
    data[:, 4] = 0.01  # a constant series has no correlation
    full = risk.full_matrix(risk.upper_matrix(returns_frame(spark, data, symbols), per_block)).collect()
    assert len(full) == 121
    cov = np.cov(data, rowvar=False)
    for r in full:
        i, j = r.ord_x, r.ord_y
        assert (r.symbol_x, r.symbol_y) == (symbols[i], symbols[j])
        assert r.covariance == pytest.approx(cov[i, j], abs=1e-15)
        if i == j:
            assert r.correlation == 1.0
        elif 4 in (i, j):
            assert r.correlation == pytest.approx(0.0, abs=1e-6)
        else:
            assert r.correlation == pytest.approx(cov[i, j] / math.sqrt(cov[i, i] * cov[j, j]))


def test_matrix_of_one_return_is_an_error(spark):
    with pytest.raises(Exception, match="two returns"):
        risk.upper_matrix(returns_frame(spark, np.array([[0.1, 0.2]]), "AB")).collect()


def python_score(weights, corr):
    """Straight from the definition."""
    active = [i for i, w in enumerate(weights) if w > 1e-6]
    if len(active) < 2:
        return 0.0
    pairs = [(i, j) for i in active for j in active if i < j]
    total = sum(weights[i] * weights[j] for i, j in pairs)
    mean = sum(weights[i] * weights[j] * abs(corr[i][j]) for i, j in pairs) / total
    effective = 1 / sum(w * w for w in weights if w > 1e-12)
    return max(0.0, min(1.0, 0.8 * (1 - mean) + 0.2 * min(1.0, effective / len(active))))


def test_diversification_of_any_portfolio(spark):
    n = 6
    data = np.random.default_rng(6).normal(0, 0.02, (30, n))
    data[:, 1] = data[:, 0] * 0.5 + data[:, 1] * 0.1
    corr = np.corrcoef(data, rowvar=False)
    cases = {
        "equal": [1 / n] * n,
        "single": [1.0] + [0.0] * (n - 1),
        "none": [0.0] * n,
        "tiny": [0.5, 0.5 - 5e-7, 5e-7] + [0.0] * (n - 3),
        "mixed": [0.4, 0.3, 0.2, 0.1, 0.0, 0.0],
    }
    weights = spark.createDataFrame(
        [(k, f"S{i}", i, w) for k, ws in cases.items() for i, w in enumerate(ws)],
        "portfolio_type string, symbol string, ord int, weight double",
    )
    upper = risk.upper_matrix(returns_frame(spark, data, [f"S{i}" for i in range(n)]))
    got = {r.portfolio_type: r for r in portfolio.diversification(weights, upper).collect()}
    for name, ws in cases.items():
        assert got[name].diversification_score == pytest.approx(python_score(ws, corr)), name
    assert got["tiny"].n_active == 2 and got["none"].n_active == 0


def legs_frame(spark, n_assets, n, **kw):
    args = {"seed": 42, "min_active": 5, "max_active": 15, "min_weight": 0.1, **kw}
    return candidates.candidate_legs(spark, F.lit(n_assets), n, **args)


def test_candidates_obey_the_constraints(spark):
    rows = legs_frame(spark, 25, 2000).collect()
    sizes = [len(r.legs) for r in rows]
    assert (min(sizes), max(sizes)) == (5, 10)  # ten assets of 10 % fill the portfolio
    assert [r.simulation_id for r in rows] == list(range(1, 2001))
    picked = np.zeros(25)
    for r in rows:
        ords = [leg.ord for leg in r.legs]
        assert len(set(ords)) == len(ords) and 0 <= min(ords) and max(ords) < 25
        assert sum(leg.weight for leg in r.legs) == pytest.approx(1.0, abs=1e-9)
        assert min(leg.weight for leg in r.legs) >= 0.1 - 1e-12
        picked[ords] += 1
    # sizes and assets are uniform: every count lies near its expectation
    share = np.bincount(sizes, minlength=11)[5:] / 2000
    assert np.all(np.abs(share - 1 / 6) < 0.04)
    assert np.all(np.abs(picked / picked.sum() - 1 / 25) < 0.008)


def test_extra_weight_follows_a_flat_dirichlet(spark):
    rows = legs_frame(spark, 4, 4000, min_active=4, max_active=4, min_weight=0.0).collect()
    first = np.array([r.legs[0].weight for r in rows])
    # a Beta(1, 3) variable: mean 1/4, variance 3/80
    assert first.mean() == pytest.approx(0.25, abs=0.01)
    assert first.var() == pytest.approx(3 / 80, abs=0.004)


def test_draws_do_not_depend_on_partitioning(spark):
    key = "spark.default.parallelism"
    one = legs_frame(spark, 25, 50).coalesce(1).collect()
    many = legs_frame(spark, 25, 50).repartition(7).orderBy("simulation_id").collect()
    assert one == many, key
    assert one != legs_frame(spark, 25, 50, seed=7).collect()


@pytest.mark.parametrize(
    "kw", [{"min_weight": 1.0}, {"min_weight": -0.1}, {"min_active": 0}, {"min_active": 9, "max_active": 8}]
)
def test_bad_constraints(spark, kw):
    with pytest.raises(ValueError):
        legs_frame(spark, 25, 1, **kw)


def test_infeasible_constraints(spark):
    with pytest.raises(Exception, match="feasible"):
        legs_frame(spark, 25, 1, min_active=5, max_active=9, min_weight=0.3).collect()


def test_small_universe_lowers_the_range(spark):
    assert {len(r.legs) for r in legs_frame(spark, 3, 50).collect()} == {3}


def test_scores_against_the_return_series(spark):
    n, days, periods = 12, 60, 252
    symbols = [f"S{i:02d}" for i in range(n)]
    data = np.random.default_rng(7).normal(0.001, 0.02, (days, n))
    upper = risk.upper_matrix(returns_frame(spark, data, symbols))
    legs = legs_frame(spark, n, 60)
    corr = np.corrcoef(data, rowvar=False)
    scores = {r.simulation_id: r for r in candidates.score_candidates(legs, upper, 0.01, periods).collect()}
    assert len(scores) == 60
    for row in legs.collect():
        w = np.zeros(n)
        for leg in row.legs:
            w[leg.ord] = leg.weight
        series = data @ w
        got = scores[row.simulation_id]
        annual = (1 + series.mean()) ** periods - 1
        vol = series.std(ddof=1) * math.sqrt(periods)
        assert got.annualized_return == pytest.approx(annual)
        assert got.annualized_volatility == pytest.approx(vol)
        assert got.sharpe_ratio == pytest.approx((annual - 0.01) / vol)
        assert got.diversification_score == pytest.approx(python_score(list(w), corr))


def test_best_candidate_breaks_ties_by_id(spark):
    scores = spark.createDataFrame([(3, 2.0), (2, 2.0), (1, 1.0)], "simulation_id int, sharpe_ratio double")
    assert candidates.best_candidate(scores).first().simulation_id == 2
    flags = {r.simulation_id: r.is_optimal for r in candidates.flag_best(scores).collect()}
    assert flags == {1: 0, 2: 1, 3: 0}


def test_ranked_weights_keep_universe_order_on_ties(spark):
    weights = spark.createDataFrame(
        [("p", "C", 0, 0.25), ("p", "A", 1, 0.5), ("p", "B", 2, 0.25), ("p", "D", 3, 1e-9)],
        "portfolio_type string, symbol string, ord int, weight double",
    )
    rows = portfolio.ranked_weights(weights).orderBy("weight_rank").collect()
    assert [(r.symbol, r.weight_rank) for r in rows] == [("A", 1), ("C", 2), ("B", 3)]


def test_whole_scenario(spark):
    """Stale symbols are skipped, a baseline symbol outside the universe is dropped."""
    symbols = [f"S{i}" for i in range(8)]
    prices = random_prices(symbols, 60, seed=8)
    del prices["S3"][59]
    closes = closes_frame(spark, prices)
    baseline = spark.createDataFrame(
        [("baseline", "S0", 0.5), ("baseline", "S3", 0.5)], "portfolio_type string, symbol string, weight double"
    )
    config = ScenarioConfig("t", "S1", lookback=40, buffer=5, min_history=20, simulations=200)
    run = Scenario(closes, universe_frame(spark, symbols), baseline, config).prepare().simulate()
    tables = {name: df.collect() for name, df in run.tables().items()}
    assert tables["portfolio_scenarios"][0].asset_universe_size == 7
    assert len(tables["portfolio_correlation_matrix"]) == 49
    assert len(tables["portfolio_simulations"]) == 200
    assert sum(r.is_optimal for r in tables["portfolio_simulations"]) == 1
    stored = tables["portfolio_weights"]
    assert [(r.symbol, r.weight) for r in stored if r.portfolio_type == "baseline"] == [("S0", 0.5)]
    best = [r for r in tables["portfolio_simulations"] if r.is_optimal][0]
    metrics = {r.portfolio_type: r for r in tables["portfolio_metrics"]}
    assert metrics["optimized"].sharpe_ratio == pytest.approx(best.sharpe_ratio)
    assert metrics["optimized"].sharpe_ratio == pytest.approx(
        max(r.sharpe_ratio for r in tables["portfolio_simulations"])
    )
    assert metrics["benchmark"].diversification_score == 0.0
    series = tables["portfolio_backtest_series"]
    assert len(series) == 3 * 40
    assert all(r.drawdown <= 0 for r in series)
    paths = {(r.portfolio_type, r.date): r for r in series}
    for r in series:
        if r.portfolio_type == "benchmark":
            assert r.benchmark_value is None
        else:
            assert r.benchmark_value == paths["benchmark", r.date].portfolio_value


def scenario_inputs(spark, days=60):
    symbols = [f"S{i}" for i in range(6)]
    baseline = spark.createDataFrame(
        [("baseline", "S0", 1.0)], "portfolio_type string, symbol string, weight double"
    )
    return closes_frame(spark, random_prices(symbols, days, seed=9)), universe_frame(spark, symbols), baseline


def test_run_scenario_publishes_and_counts(spark, tmp_path):
    config = ScenarioConfig("t", "S1", lookback=40, buffer=5, min_history=20, simulations=50)
    counts = run_scenario(*scenario_inputs(spark), config, str(tmp_path / "store"))
    assert {r.table_name: r.n_rows for r in counts.collect()} == {
        "portfolio_scenarios": 1,
        "portfolio_weights": 1 + len(
            spark.read.parquet(str(tmp_path / "store" / "portfolio_weights"))
            .where("portfolio_type = 'optimized'").collect()
        ),
        "portfolio_metrics": 3,
        "portfolio_correlation_matrix": 36,
        "portfolio_backtest_series": 120,
        "portfolio_simulations": 50,
    }


@pytest.mark.parametrize(
    "benchmark, min_history, message", [("NONE", 20, "benchmark"), ("S1", 90, "common dates")]
)
def test_run_scenario_refuses_unsound_input(spark, tmp_path, benchmark, min_history, message):
    config = ScenarioConfig("t", benchmark, lookback=100, min_history=min_history, simulations=5)
    with pytest.raises(Exception, match=message):
        run_scenario(*scenario_inputs(spark), config, str(tmp_path / "store"))
