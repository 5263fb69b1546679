"""Cleaning and quality rules on damaged rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlelake.operators import clean, quality, upsert
from candlelake.schemas import CANDLE_COLUMNS, CANDLE_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0)


def candle(minute=0, symbol="BTCUSDT", **changes):
    row = {
        "timestamp": T0 + dt.timedelta(minutes=minute),
        "symbol": symbol,
        "open": 10.0,
        "high": 12.0,
        "low": 9.0,
        "close": 11.0,
        "volume": 5.0,
        "close_time": T0 + dt.timedelta(minutes=minute, seconds=59),
        "quote_asset_volume": 55.0,
        "number_of_trades": 3,
        "taker_buy_base_asset_volume": 2.0,
        "taker_buy_quote_asset_volume": 22.0,
    }
    row.update(changes)
    return tuple(row[c] for c in CANDLE_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), CANDLE_SCHEMA)


def test_clean_trims_drops_incomplete_and_duplicates(spark):
    df = frame(
        spark,
        candle(0, " BTCUSDT "),
        candle(0),
        candle(1),
        candle(1),
        candle(2, close=None),
        candle(3, close=float("nan")),
        candle(4, symbol=None),
        candle(5, number_of_trades=None),
    )
    rows = clean.clean_candles(df).orderBy("timestamp").collect()
    assert [(r.timestamp, r.symbol) for r in rows] == [
        (T0, "BTCUSDT"),
        (T0 + dt.timedelta(minutes=1), "BTCUSDT"),
    ]


def test_duplicate_survivor_does_not_depend_on_partitioning(spark):
    rows = [candle(0, close=10.0 + i / 10) for i in range(10)]
    kept = {
        clean.drop_duplicates(frame(spark, *rows).repartition(n)).first().close for n in (1, 3, 7)
    }
    assert kept == {10.0}


def test_hot_key_is_limited_before_the_shuffle(spark):
    plan = clean.drop_duplicates(frame(spark, candle(0)))._jdf.queryExecution().toString()
    exchange = plan.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], "copies of a key must be cut map-side"


@pytest.mark.parametrize(
    "changes, strict, weak",
    [
        ({}, True, True),
        ({"volume": 0.0}, True, True),
        ({"volume": -1.0}, False, False),
        ({"open": 0.0}, False, False),
        ({"high": 8.0}, False, False),
        ({"high": 10.5}, False, True),  # below the close
        ({"low": 10.5}, False, True),  # above the open
        ({"low": 0.0}, False, True),
        ({"close": -1.0}, False, True),
    ],
)
def test_quality_rules(spark, changes, strict, weak):
    df = frame(spark, candle(0, **changes))
    assert quality.quality_strict(df).count() == int(strict)
    assert quality.quality_weak(df).count() == int(weak)


def test_excluded_symbols(spark):
    df = frame(spark, candle(0, "A"), candle(0, "B"), candle(0, "C"))
    assert [r.symbol for r in clean.exclude_symbols(df, {"A", "C"}).collect()] == ["B"]


def test_union_keeps_shared_keys_unless_told(spark):
    one, two = frame(spark, candle(0)), frame(spark, candle(0, close=11.5), candle(1))
    assert clean.union_sources(one, two).count() == 3
    assert clean.union_sources(one, two, dedup=True).count() == 2


def test_date_cutoff_splits_at_midnight_and_reaches_the_scan(spark, tmp_path):
    df = frame(spark, candle(-1), candle(0), candle(1))
    assert clean.from_date(df, "2024-01-01").count() == 2
    path = str(tmp_path / "lake")
    df.write.parquet(path)
    plan = clean.from_date(spark.read.parquet(path), "2024-01-01")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(timestamp" in plan.split("PushedFilters")[-1]


def test_missing_slots_counts_days_without_bars(spark):
    df = frame(spark, candle(0), candle(0), candle(2), candle(2 * 1440))
    rows = quality.missing_slots(df, 60).orderBy("date").collect()
    assert [(r.n_present, r.n_missing) for r in rows] == [(2, 1438), (0, 1440), (1, 1439)]


def test_gaps_across_chunks(spark):
    df = frame(spark, candle(0), candle(1), candle(1439), candle(1440), candle(3 * 1440 + 5))
    rows = quality.gaps(df, 60, chunk="day").orderBy("gap_before").collect()
    assert [r.n_missing for r in rows] == [1437, 2 * 1440 + 4]


def test_freshness_and_lag(spark):
    df = frame(spark, candle(0, "A"), candle(9, "B"))
    now = F.lit("2024-01-01 00:10:00").cast("timestamp")
    assert {r.symbol: r.is_stale for r in quality.freshness(df, now).collect()} == {"A": 1, "B": 0}
    assert {r.symbol: r.lag_seconds for r in quality.ingestion_lag(df, now).collect()} == {"A": 600, "B": 60}


def test_latest_version_and_source_priority(spark):
    rows = spark.createDataFrame(
        [("A", 1, "old"), ("A", 2, "new"), ("B", 1, "only")], "k string, v int, what string"
    )
    assert {r.k: r.what for r in upsert.latest_wins(rows, ["k"], "v").collect()} == {"A": "new", "B": "only"}
    batch = frame(spark, candle(0, close=10.5))
    stream = frame(spark, candle(0, close=11.5), candle(1, close=11.5))
    got = upsert.batch_over_stream(batch, stream).orderBy("timestamp").collect()
    assert [(r.close, r.source) for r in got] == [(10.5, "batch"), (11.5, "stream")]


def test_guards(spark):
    closes = spark.createDataFrame(
        [("A", dt.date(2024, 1, d), c) for d, c in ((1, 1.0), (2, 0.0), (3, 2.0))],
        "symbol string, date date, close double",
    )
    universe = spark.createDataFrame([("A", 0), ("B", 1)], "symbol string, ord int")
    dates = closes.select("date")
    report = quality.guard_report(closes, universe, dates, closes, "B", 5)
    assert {r.guard: r.violations for r in report.collect()} == {
        "price_not_positive": 1,
        "symbol_without_history": 1,
        "benchmark_missing": 0,
        "history_too_short": 3,
    }
