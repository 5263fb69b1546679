"""Column lists and schemas of the candle tables and the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The canonical candle column order and the positional layout of
# one raw exchange kline. The names are the tables' public contract.
CANDLE_COLUMNS = [
    "timestamp",
    "symbol",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
]
KLINE_COLUMNS = [
    "timestamp",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
    "ignore",
]
# every column is a number with a fraction, but for these
OTHER_TYPES = {
    "symbol": T.StringType(),
    "ignore": T.StringType(),
    "timestamp": T.TimestampType(),
    "close_time": T.TimestampType(),
    "number_of_trades": T.LongType(),
}


def struct_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, OTHER_TYPES.get(c, T.DoubleType()), True) for c in columns])


CANDLE_SCHEMA = struct_of(CANDLE_COLUMNS)
CSV_ARCHIVE_SCHEMA = struct_of(KLINE_COLUMNS)


def _of_type(kind: type) -> list[str]:
    return [f.name for f in CANDLE_SCHEMA if isinstance(f.dataType, kind)]


TIMESTAMP_COLUMNS = _of_type(T.TimestampType)
LONG_COLUMNS = _of_type(T.LongType)
DOUBLE_COLUMNS = _of_type(T.DoubleType)

# One message of the candle stream.
STREAM_CANDLE_SCHEMA = (
    "symbol string, open double, high double, low double, close double, volume double, "
    "open_time long, close_time long, is_closed boolean"
)

# Exchange message whose payload sits in the nested object ``k``.
KLINE_MESSAGE_SCHEMA = "k struct<t:long,o:string,h:string,l:string,c:string,v:string>"

# Result tables of one portfolio scenario.
RESULT_SCHEMAS = {
    "portfolio_scenarios": (
        "scenario_id string, scenario_name string, investor_name string, initial_capital double, "
        "baseline_label string, benchmark_symbol string, optimization_objective string, "
        "rebalance_frequency string, risk_free_rate double, training_start_date date, "
        "training_end_date date, backtest_start_date date, backtest_end_date date, "
        "asset_universe_size int, created_at timestamp"
    ),
    "portfolio_weights": (
        "scenario_id string, portfolio_type string, simulation_id int, symbol string, "
        "weight double, weight_rank int, notes string, created_at timestamp"
    ),
    "portfolio_metrics": (
        "scenario_id string, portfolio_type string, as_of_date date, sharpe_ratio double, "
        "avg_daily_return double, annualized_return double, portfolio_volatility double, "
        "annualized_volatility double, diversification_score double, "
        "diversification_label string, ending_value double, pct_gain double, created_at timestamp"
    ),
    "portfolio_correlation_matrix": (
        "scenario_id string, as_of_date date, symbol_x string, symbol_y string, "
        "correlation double, abs_correlation double, created_at timestamp"
    ),
    "portfolio_backtest_series": (
        "scenario_id string, portfolio_type string, date date, portfolio_value double, "
        "cumulative_return double, daily_return double, drawdown double, "
        "benchmark_value double, created_at timestamp"
    ),
    "portfolio_simulations": (
        "scenario_id string, simulation_id int, annualized_return double, "
        "annualized_volatility double, sharpe_ratio double, diversification_score double, "
        "is_optimal int, created_at timestamp"
    ),
}


def result_columns(table: str) -> list[str]:
    return [part.split()[0] for part in RESULT_SCHEMAS[table].split(", ")]
