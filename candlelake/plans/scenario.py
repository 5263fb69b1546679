"""Portfolio scenario: from stored closes to the six result tables."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlelake.operators.candidates import (
    best_candidate,
    candidate_legs,
    candidate_weights,
    flag_best,
    score_candidates,
)
from candlelake.operators.panel import (
    asset_returns,
    panel_with_fallback,
    require_history,
)
from candlelake.operators.portfolio import (
    backtest,
    dense_weights,
    diversification,
    portfolio_returns,
    ranked_weights,
    single_asset_weights,
    summarize,
    with_benchmark_value,
)
from candlelake.operators.risk import full_matrix, upper_matrix
from candlelake.operators.setops import fresh_symbols, usable_universe
from candlelake.plans.staging import staged
from candlelake.schemas import RESULT_SCHEMAS, result_columns
from candlelake.sinks import delete_folders, write_partitioned

# Portfolio types and the notes stored with their weights.
BASELINE, OPTIMIZED, BENCHMARK = "baseline", "optimized", "benchmark"
BASELINE_NOTE = "User-defined baseline portfolio"
OPTIMIZED_NOTE = "Monte Carlo max-sharpe portfolio"


@dataclass(frozen=True)
class ScenarioConfig:
    """Parameters of one scenario; the numbers are the usual defaults."""

    scenario_id: str
    benchmark_symbol: str
    scenario_name: str = ""
    investor_name: str = ""
    baseline_label: str = ""
    initial_capital: float = 10_000.0
    optimization_objective: str = "max_sharpe"
    rebalance_frequency: str = "daily"
    risk_free_rate: float = 0.0
    lookback: int = 365
    buffer: int = 45
    min_history: int = 180
    period_days: int = 1
    periods_per_year: int = 252
    simulations: int = 10_000
    seed: int = 42
    min_active: int = 5
    max_active: int = 15
    min_weight: float = 0.10


def numbered(universe: DataFrame) -> DataFrame:
    """Renumber a filtered universe 0..n-1 in its order.

    A universe is a configured list of symbols; ranking it in one task is fine.
    """
    order = W.orderBy("ord")
    return universe.select("symbol", (F.row_number().over(order) - 1).alias("ord"))


class Scenario:
    """The steps of one scenario as lazy frames over stored closes.

    ``closes`` and ``universe`` are read by several steps, so pass stored
    tables. Frames that many steps share are stored once by ``stage``.
    """

    def __init__(self, closes: DataFrame, universe: DataFrame, baseline: DataFrame, config: ScenarioConfig):
        self.config = config
        self.closes = closes
        self.baseline = baseline
        fresh = fresh_symbols(closes, ts="date")
        self.universe = numbered(usable_universe(universe, fresh))
        self.returns = None
        self.upper = None
        self.scores = None

    def prepare(self, stage: bool = True, strict: bool = False) -> "Scenario":
        """Usable universe, panel, returns and the matrix.

        ``strict`` fails on a missing benchmark or a short history; otherwise
        a short history gives empty results.
        """
        c = self.config
        keep = staged if stage else (lambda df, name: df)
        self.universe = keep(self.universe, "universe")
        self.panel = panel_with_fallback(
            self.closes, self.universe, c.lookback, c.buffer, c.min_history, c.period_days
        )
        if strict:
            check_benchmark(self.universe, c.benchmark_symbol)
            self.panel = require_history(self.panel, c.min_history)
        self.returns = keep(asset_returns(self.panel), "returns")
        self.upper = upper_matrix(self.returns)
        return self

    def simulate(self, stage: bool = True) -> "Scenario":
        """Candidates and their scores; the matrix is stored for all later steps."""
        c = self.config
        if stage:
            self.upper = staged(self.upper, "matrix")
        n_assets = self.universe.agg(F.count(F.lit(1))).scalar()
        self.legs = candidate_legs(
            self.universe.sparkSession, n_assets, c.simulations, c.seed,
            c.min_active, c.max_active, c.min_weight,
        )
        scores = score_candidates(self.legs, self.upper, c.risk_free_rate, c.periods_per_year)
        self.scores = staged(scores, "scores") if stage else scores
        return self

    def best_weights(self) -> DataFrame:
        """Weights of the optimal candidate; only its id is looked up in the legs."""
        best = best_candidate(self.scores).select("simulation_id").scalar()
        mine = self.legs.where(F.col("simulation_id") == best)
        return candidate_weights(mine, self.universe)

    def weights(self) -> DataFrame:
        """Dense weights of the baseline, optimized and benchmark portfolios."""
        best = self.best_weights().select(F.lit(OPTIMIZED).alias("portfolio_type"), "symbol", "weight")
        return (
            dense_weights(self.universe, self.baseline, BASELINE)
            .unionByName(dense_weights(self.universe, best, OPTIMIZED))
            .unionByName(single_asset_weights(self.universe, self.config.benchmark_symbol, BENCHMARK))
        )

    def series(self, weights: DataFrame) -> DataFrame:
        return portfolio_returns(self.returns, weights)

    def scenario_rows(self) -> DataFrame:
        """One row: settings, date spans and the size of the universe."""
        c = self.config
        size = self.universe.agg(F.count(F.lit(1))).scalar()
        first_return = self.returns.agg(F.min("date")).scalar()
        text = {
            "scenario_id": c.scenario_id,
            "scenario_name": c.scenario_name,
            "investor_name": c.investor_name,
            "initial_capital": float(c.initial_capital),
            "baseline_label": c.baseline_label,
            "benchmark_symbol": c.benchmark_symbol,
            "optimization_objective": c.optimization_objective,
            "rebalance_frequency": c.rebalance_frequency,
            "risk_free_rate": float(c.risk_free_rate),
        }
        span = self.panel.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        return span.select(
            *[F.lit(v).alias(k) for k, v in text.items()],
            F.col("first").alias("training_start_date"),
            F.col("last").alias("training_end_date"),
            first_return.alias("backtest_start_date"),
            F.col("last").alias("backtest_end_date"),
            size.cast("int").alias("asset_universe_size"),
        )

    def weight_rows(self, weights: DataFrame) -> DataFrame:
        """Ranked baseline and optimized weights with a note and the candidate id."""
        best = best_candidate(self.scores).select("simulation_id").scalar()
        is_optimized = F.col("portfolio_type") == OPTIMIZED
        stored = ranked_weights(weights.where(F.col("portfolio_type") != BENCHMARK))
        return stored.select(
            "portfolio_type",
            F.when(is_optimized, best).alias("simulation_id"),
            "symbol",
            "weight",
            "weight_rank",
            F.when(is_optimized, OPTIMIZED_NOTE).otherwise(BASELINE_NOTE).alias("notes"),
        )

    def metric_rows(self, weights: DataFrame) -> DataFrame:
        c = self.config
        summary = summarize(
            self.series(weights), c.initial_capital, c.risk_free_rate, c.periods_per_year
        )
        scores = diversification(weights, self.upper).select(
            "portfolio_type", "diversification_score", "diversification_label"
        )
        return summary.join(scores, "portfolio_type")

    def correlation_rows(self) -> DataFrame:
        as_of = self.returns.agg(F.max("date")).scalar()
        return full_matrix(self.upper).select(
            as_of.alias("as_of_date"),
            "symbol_x",
            "symbol_y",
            "correlation",
            F.abs("correlation").alias("abs_correlation"),
        )

    def backtest_rows(self, weights: DataFrame) -> DataFrame:
        paths = backtest(self.series(weights), self.config.initial_capital)
        return with_benchmark_value(paths, BENCHMARK)

    def simulation_rows(self) -> DataFrame:
        return flag_best(self.scores)

    def tables(self) -> dict[str, DataFrame]:
        """The six result tables, each with the scenario id and the creation time."""
        weights = staged(self.weights(), "weights")
        rows = {
            "portfolio_scenarios": self.scenario_rows(),
            "portfolio_weights": self.weight_rows(weights),
            "portfolio_metrics": self.metric_rows(weights),
            "portfolio_correlation_matrix": self.correlation_rows(),
            "portfolio_backtest_series": self.backtest_rows(weights),
            "portfolio_simulations": self.simulation_rows(),
        }
        return {
            name: df.withColumn("scenario_id", F.lit(self.config.scenario_id))
            .withColumn("created_at", F.current_timestamp())
            .select(result_columns(name))
            for name, df in rows.items()
        }


def check_benchmark(universe: DataFrame, symbol: str) -> None:
    """Stop before any work if the benchmark is not usable."""
    if universe.where(F.col("symbol") == symbol).isEmpty():
        raise ValueError(f"benchmark symbol {symbol} is missing or stale")


# what a strict run says when it stops
_REASONS = re.compile(
    r"benchmark symbol \S+ is missing or stale|need at least \d+ common dates, got \d+|close is not positive for \S+"
    r"|weight string of \S+ rejected: \d+ bad items, total [\w.]+"
)


def stop_reason(closes: DataFrame, universe: DataFrame, baseline: DataFrame, config: ScenarioConfig) -> str | None:
    """Why a strict run over these inputs stops before its results, or null if it would not. Other errors are passed on."""
    try:
        run = Scenario(closes, universe, baseline, config).prepare(strict=True)
        staged(dense_weights(run.universe, baseline, BASELINE), "weights")
    except Exception as error:  # a check inside a scalar subquery comes as an error of the bridge to the JVM
        found = _REASONS.search(str(error))
        if not found:
            raise
        return found[0]
    return None


_RUNS = "runs"


def publish(tables: dict[str, DataFrame], root: str, scenario_id: str) -> None:
    """Store the result tables of one scenario as one: readers see all tables of its last complete run, or those of the run before.

    Every table gets the rows as a run of its own; then one row appended to the list of runs makes them current, also for tables in which
    the scenario has no rows any more. A failure before that leaves the old results whole. Runs that are no longer current are deleted
    afterwards; other scenarios stay.
    """
    spark = next(iter(tables.values())).sparkSession
    run_id = uuid.uuid4().hex
    for name, df in tables.items():
        write_partitioned(df.withColumn("run_id", F.lit(run_id)), f"{root}/{name}", ["scenario_id", "run_id"], "append")
    done = spark.range(1).select(F.lit(scenario_id).alias("scenario_id"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("published_at"))
    done.coalesce(1).write.mode("append").parquet(f"{root}/{_RUNS}")
    for name in tables:
        delete_folders(spark, f"{root}/{name}/scenario_id={scenario_id}", keep=[f"run_id={run_id}"])


def read_results(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table in its column order: the current run of every scenario."""
    runs = spark.read.schema("scenario_id string, run_id string, published_at timestamp").parquet(f"{root}/{_RUNS}")
    # a row per scenario; the length lets the optimizer expect that folders can be left out
    current = runs.where(F.length("run_id") > 0).groupBy("scenario_id").agg(F.max_by("run_id", "published_at").alias("run_id"))
    stored = spark.read.schema(f"{RESULT_SCHEMAS[name]}, run_id string").parquet(f"{root}/{name}")
    return stored.join(current, ["scenario_id", "run_id"], "left_semi").select(result_columns(name))


def scenario_counts(spark: SparkSession, root: str, scenario_id: str) -> DataFrame:
    """Stored rows of one scenario per table."""
    counts = None
    for name in RESULT_SCHEMAS:
        one = (
            read_results(spark, root, name)
            .where(F.col("scenario_id") == scenario_id)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("table_name"), "n_rows")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def run_scenario(
    closes: DataFrame, universe: DataFrame, baseline: DataFrame, config: ScenarioConfig, root: str
) -> DataFrame:
    """Check the inputs, compute and publish all tables, and count the stored rows."""
    run = Scenario(closes, universe, baseline, config).prepare(strict=True).simulate()
    publish(run.tables(), root, config.scenario_id)
    return scenario_counts(closes.sparkSession, root, config.scenario_id)
