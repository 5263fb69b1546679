"""Cases that once went wrong, and the plans that hot paths must keep."""

import datetime as dt

from pyspark.sql import functions as F

from candlelake import sinks, sources
from candlelake.functions.lookback import over_lookback
from candlelake.operators import bars, portfolio, quality, snapshots, upsert
from candlelake.plans import bindings, dashboard, etl
from candlelake.schemas import CANDLE_COLUMNS, CANDLE_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)


def candles(spark, rows):
    """Candles of ``(symbol, seconds after the first day's start)``, or with a close."""
    full = [
        (DAY + dt.timedelta(seconds=r[1]), r[0], 1.0, 2.0, 0.5, float(r[2]) if len(r) > 2 else 1.5, 1.0, DAY, 1.0, 1, 1.0, 1.0)
        for r in rows
    ]
    return spark.createDataFrame(full, CANDLE_SCHEMA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numeric_symbols_stay_text(spark, tmp_path):
    rows = candles(spark, [("007", 0), ("1e5", 60)]).withColumn("date", F.to_date("timestamp"))
    sinks.write_partitioned(rows, f"{tmp_path}/lake", ["symbol", "date"])
    back = sources.read_partitioned(spark, f"{tmp_path}/lake")
    assert sorted(r.symbol for r in back.collect()) == ["007", "1e5"]
    assert back.where("symbol = '007'").count() == 1


def test_daily_layout(spark, tmp_path):
    rows = candles(spark, [("A", 0), ("B", 60), ("A", 86_400)])
    for _ in range(2):
        sinks.write_daily_folder(rows, str(tmp_path), "2024-01-01")
    back = sources.read_daily_folder(spark, str(tmp_path), "2024-01-01")
    assert back.columns == CANDLE_COLUMNS and sorted(r.symbol for r in back.collect()) == ["A", "B"]


def test_equal_versions_have_one_winner(spark):
    rows = [("k", 1, 5.0, "a"), ("k", 1, 7.0, "b"), ("k", 0, 9.0, "c")]
    schema = "key string, version int, close double, source string"
    for order in (rows, rows[::-1]):
        kept = upsert.latest_wins(spark.createDataFrame(order, schema), ["key"], "version").collect()
        assert [(r.close, r.source) for r in kept] == [(7.0, "b")]


def test_serving_view_prunes_months(spark, tmp_path):
    rows = candles(spark, [("A", 0), ("A", 0, 3.0), ("A", 40 * 86_400)])
    etl.serving_load(rows, f"{tmp_path}/serving")
    view = etl.serving_view(spark, f"{tmp_path}/serving").where("month = '202401'")
    assert [r.close for r in view.collect()] == [3.0]
    assert "month#" in plan_of(view).split("PartitionFilters: [")[1].split("]")[0]


def test_backfill_empties_dates_without_candles(spark, tmp_path):
    target = f"{tmp_path}/silver"
    sinks.write_by_date(candles(spark, [("A", 0), ("A", 86_400), ("A", 2 * 86_400)]), target)
    etl.backfill(candles(spark, [("B", 0)]), target, "2024-01-01", "2024-01-02")
    assert sorted((r.symbol, str(r.date)) for r in spark.read.parquet(target).collect()) == [("A", "2024-01-03"), ("B", "2024-01-01")]


def test_an_empty_folder_is_no_date(spark, tmp_path):
    target = f"{tmp_path}/silver"
    (tmp_path / "silver" / "date=2024-01-01").mkdir(parents=True)
    sinks.append_missing_dates(candles(spark, [("A", 0)]), target)
    assert spark.read.parquet(target).count() == 1


def test_no_gap_without_a_missing_bar(spark):
    found = quality.gaps(candles(spark, [("A", 0), ("A", 90), ("A", 240)]), 60).collect()
    assert [(r.n_missing) for r in found] == [1]


def test_silent_symbols_miss_bars(spark):
    found = quality.missing_slots(candles(spark, [("A", 0), ("B", 0), ("B", 86_400)]), 60)
    assert {(r.symbol, str(r.date)): r.n_missing for r in found.collect()}[("A", "2024-01-02")] == 1440


def test_coins_without_attributes_stay(spark):
    seen = spark.createDataFrame([("c1", DAY), ("c2", DAY)], "coin_id string, snapshot_time timestamp")
    known = spark.createDataFrame([("c1", "X")], "coin_id string, symbol string")
    assert {r.coin_id: r.symbol for r in snapshots.first_seen(seen, known).collect()} == {"c1": "X", "c2": None}


def test_dashboard_keeps_scenarios_apart(spark):
    weights = spark.createDataFrame(
        [(s, "optimized", "A", w, 1, 3) for s, w in (("s1", 0.4), ("s2", 0.6))],
        "scenario_id string, portfolio_type string, symbol string, weight double, weight_rank int, simulation_id int",
    )
    assert [r.weight for r in dashboard.allocation(weights, "s2", "optimized").collect()] == [0.6]
    series = spark.createDataFrame(
        [("s1", "baseline", "d", 100.0), ("s2", "baseline", "d", 900.0)],
        "scenario_id string, portfolio_type string, date string, portfolio_value double",
    )
    assert [r.baseline for r in dashboard.value_path(series, "s2", ["baseline"]).collect()] == [900.0]


def test_bars_and_closes_hash(spark):
    ticks = bindings.ticks(spark, SF_DIR)
    for df in (
        bars.bars_from_ticks(ticks, "minute"),
        bars.daily_close(ticks, "price", "tick_id"),
    ):
        assert "SortAggregate" not in plan_of(df)
    # the overall row is built from one row per symbol; the ticks themselves are hashed
    bounds = plan_of(bars.series_bounds(ticks, "price", "tick_id"))
    assert "HashAggregate(keys=[symbol" in bounds and bounds.count("SortAggregate") == 2


def test_daily_close_bounds_the_scan(spark):
    ticks = bindings.ticks(spark, SF_DIR)
    closes = bars.daily_close(ticks, "price", "tick_id", ["click"], "2024-01-03", "2024-01-05")
    assert {str(r.date) for r in closes.collect()} == {"2024-01-03", "2024-01-04", "2024-01-05"}
    assert "EqualTo(event_type,click)" in plan_of(closes)


def test_lookback_lends_few_records(spark):
    """With one row a chunk, a window of n rows lends n rows to each chunk and no more."""
    n, span = 400, 50
    rows = spark.range(n).select(F.lit("A").alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    out = over_lookback(
        rows, "k", "t", span, F.col("t"), {"s": lambda w: F.sum("v").over(w.rowsBetween(-span, 0))}
    )
    assert [r.s for r in out.orderBy("t").collect()] == [sum(range(max(0, i - span), i + 1)) for i in range(n)]


def test_many_portfolios_join_only_what_they_hold(spark):
    """Rows grow with held symbols and held pairs, not with portfolios times symbols."""
    n_symbols, n_portfolios, held = 40, 2_000, 3
    universe = spark.range(n_symbols).select(F.format_string("S%02d", "id").alias("symbol"), F.col("id").cast("int").alias("ord"))
    weights = (
        spark.range(n_portfolios).select(F.col("id").cast("string").alias("portfolio_type"), F.col("id").alias("p"))
        .join(universe)
        .withColumn("weight", F.when(F.pmod(F.col("ord") - F.col("p"), F.lit(n_symbols)) < held, 1 / held).otherwise(0.0))
        .drop("p")
    )
    returns = universe.select("symbol", F.lit("d").alias("date"), F.lit(0.01).alias("ret"))
    series = portfolio.portfolio_returns(returns, weights).collect()
    assert len(series) == n_portfolios and all(abs(r.ret - 0.01) < 1e-12 for r in series)
    upper = universe.alias("x").join(universe.alias("y"), F.col("x.ord") <= F.col("y.ord")).select(
        F.col("x.ord").alias("ord_x"), F.col("y.ord").alias("ord_y"), F.lit(0.0).alias("mean_return_x"),
        F.lit(1.0).alias("covariance"), F.lit(0.25).alias("correlation"),
    )
    scores = portfolio.diversification(weights, upper).collect()
    assert {(r.n_active, round(r.avg_abs_correlation, 9), round(r.effective_holdings, 9)) for r in scores} == {(held, 0.25, 3.0)}
    idle = portfolio.portfolio_returns(returns, weights.withColumn("weight", F.lit(0.0)))
    assert idle.count() == n_portfolios and idle.where("ret <> 0").isEmpty()
    bare = portfolio.diversification(weights, upper.limit(0)).first()
    assert bare.n_active == held
