"""Bitmaps of bars against sets of slots, prefix scans against running products, and their plans."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.functions import running_product
from candlelake.operators import bitmaps, portfolio, quality, risk

T0 = dt.datetime(2024, 1, 1)


def candles(spark, rows):
    return spark.createDataFrame([(s, T0 + dt.timedelta(minutes=m)) for s, m in rows], "symbol string, timestamp timestamp")


def some_bars(n=4000, days=70, seed=2):
    rng = np.random.default_rng(seed)
    return sorted({(str(rng.choice(["A", "B", "C"])), int(m)) for m in rng.integers(-days * 720, days * 720, n)} | {("D", 5), ("E", 1439), ("E", 1440)})


def exchanges(df):
    plan = df._jdf.queryExecution().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_gaps_equal_the_window(spark):
    df = candles(spark, some_bars())
    want = sorted(map(tuple, quality.gaps(df, 60).collect()))
    got = sorted(map(tuple, bitmaps.gaps(bitmaps.slot_bitmaps(df, 60), 60).collect()))
    assert got == want and len(got) > 1000


def test_missing_slots_equal_sets(spark):
    rows = some_bars()
    df = candles(spark, [*rows, *rows[:500], (None, 7), (None, 8)])
    got = {(r.symbol, r.date): (r.n_present, r.n_missing) for r in quality.missing_slots(df, 60).collect()}
    days = {}
    for s, m in [*rows, (None, 7), (None, 8)]:
        day = (T0 + dt.timedelta(minutes=m)).date()
        days.setdefault(s, {}).setdefault(day, set()).add(m)
    last = max(d for own in days.values() for d in own)
    want = {}
    for s, own in days.items():
        day = min(own)
        while day <= last:
            n = len(own.get(day, ()))
            want[s, day] = (n, 1440 - n)
            day += dt.timedelta(days=1)
    # a null symbol has no calendar row that joins it, so it is not compared by day
    assert {k: v for k, v in got.items() if k[0]} == {k: v for k, v in want.items() if k[0]}


def test_loads_merge(spark):
    rows = some_bars()
    one = bitmaps.slot_bitmaps(candles(spark, rows), 60)
    two = bitmaps.merged(*(bitmaps.slot_bitmaps(candles(spark, part), 60) for part in (rows[:2500], rows[1500:])))
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))


def test_hours_and_odd_units(spark):
    df = candles(spark, [("A", 0), ("A", 60), ("A", 240)])
    assert [(r.n_missing) for r in bitmaps.gaps(bitmaps.slot_bitmaps(df, 3600), 3600).collect()] == [2]
    for unit in (7, 86_400, 1):
        with pytest.raises(ValueError, match="whole number of bytes"):
            bitmaps.slot_bitmaps(df, unit)


def test_empty_and_null_times(spark):
    none = spark.createDataFrame([("A", None)], "symbol string, timestamp timestamp")
    held = bitmaps.slot_bitmaps(none, 60)
    assert held.count() == bitmaps.gaps(held, 60).count() == bitmaps.missing_slots(held, 60).count() == 0


def test_common_dates(spark):
    rng = np.random.default_rng(4)
    day = dt.date(1969, 12, 1)
    held = {s: {day + dt.timedelta(days=int(d)) for d in rng.integers(0, 90, 80)} for s in "ABCD"}
    held["A"].add(dt.date(2060, 1, 1))  # another block, which the others lack
    closes = spark.createDataFrame([(s, d, 1.0) for s, ds in held.items() for d in ds], "symbol string, date date, close double")
    universe = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2)], "symbol string, ord int")
    got = {r.date for r in bitmaps.common_dates(bitmaps.date_bitmaps(closes), universe).collect()}
    assert got == held["A"] & held["B"] & held["C"] and got
    lacking = universe.union(spark.createDataFrame([("X", 3)], "symbol string, ord int"))
    assert bitmaps.common_dates(bitmaps.date_bitmaps(closes), lacking).count() == 0


def test_no_exchange_carries_bars(spark):
    """What is shuffled first is the partial bitmap of a symbol and block."""
    df = candles(spark, some_bars(200))
    plan = bitmaps.slot_bitmaps(df, 60)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "partial_bitmap_construct_agg" in below and plan.count("Exchange") == 1


def series(spark, n=500):
    rng = np.random.default_rng(6)
    rows = [(k, int(t), None if rng.random() < 0.02 else float(rng.normal(0, 0.05))) for k in ("a", "b", None) for t in rng.permutation(n)]
    return rows, spark.createDataFrame(rows, "symbol string, at long, ret double")


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_running_product(spark, width):
    rows, df = series(spark)
    out = running_product(df, "symbol", "at", 1 + F.col("ret"), F.floor(F.col("at") / width))
    assert out.columns == ["symbol", "at", "ret", "product", "peak"]
    got = {(r.symbol, r["at"]): (r["product"], r.peak) for r in out.collect()}
    for key in ("a", "b", None):
        product, peak = 1.0, -np.inf
        for _, at, ret in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            product *= 1 + (ret or 0)
            peak = max(peak, product)
            assert got[key, at] == (pytest.approx(product, rel=1e-9), pytest.approx(peak, rel=1e-9))
    assert len(got) == len(rows)


def test_value_paths_equal_backtest(spark):
    rows, df = series(spark, 60)
    named = df.where("symbol is not null and ret is not null")
    dates = named.select(F.col("symbol").alias("portfolio_type"), F.date_add(F.lit("2024-01-01"), F.col("at").cast("int")).alias("date"), "ret")
    want = {(r.portfolio_type, r.date): r for r in portfolio.backtest(dates, 100.0).collect()}
    paths = portfolio.value_paths(dates, 100.0, F.date_trunc("week", "date"), "portfolio_type", "date").collect()
    assert len(paths) == len(want)
    for r in paths:
        w = want[r.portfolio_type, r.date]
        assert (r.portfolio_value, r.cumulative_return, r.drawdown) == pytest.approx((w.portfolio_value, w.cumulative_return, w.drawdown), abs=1e-9)
    assert min(r.peak for r in paths) >= 100.0


def test_total_loss(spark):
    df = spark.createDataFrame([("a", i, r) for i, r in enumerate([0.5, -1.0, 0.3])], "symbol string, at long, ret double")
    got = portfolio.value_paths(df, 10.0, F.col("at"), order="at").orderBy("at").collect()
    assert [(r.portfolio_value, r.peak, r.drawdown) for r in got] == [(15.0, 15.0, 0.0), (0.0, 15.0, -1.0), (0.0, 15.0, -1.0)]


def test_no_window_over_a_series(spark):
    _, df = series(spark, 20)
    plan = running_product(df, "symbol", "at", 1 + F.col("ret"), F.floor(F.col("at") / 7))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "+- Window [" in line]
    # the rows are walked per chunk; what meets by key alone are the rows that sum up chunks
    by_key = [w for w in windows if not re.search(r"\], \[symbol#\d+, _chunk#\d+L?\]", w)]
    assert len(by_key) < len(windows) and all("_key#" in w and "ret#" not in w for w in by_key)


@pytest.mark.parametrize("symbols, dates, per_block", [(1, 2, 200), (7, 31, 2), (12, 33, 5), (5, 100, 200)])
def test_gram_matrix_equals_pairs(spark, symbols, dates, per_block):
    rng = np.random.default_rng(symbols)
    x = rng.normal(0, 0.02, (dates, symbols))
    x[:, 0] = 0.01  # no variance
    day = dt.date(2024, 1, 1)
    rows = [(f"S{j}", j, day + dt.timedelta(days=i), float(x[i, j])) for i in range(dates) for j in range(symbols)]
    returns = spark.createDataFrame(rows, "symbol string, ord int, date date, ret double").repartition(5)
    got = sorted(tuple(r) for r in risk.gram_matrix(returns, per_block).collect())
    want = sorted(tuple(r) for r in risk.upper_matrix(returns, per_block).collect())
    assert len(got) == symbols * (symbols + 1) // 2
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], abs=1e-12)


def test_gram_matrix_plan(spark):
    returns = spark.createDataFrame([("A", 0, dt.date(2024, 1, 1), 0.1)], "symbol string, ord int, date date, ret double")
    plan = risk.gram_matrix(returns)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "lambda" not in plan and "Cartesian" not in plan


def test_one_return_is_too_few(spark):
    returns = spark.createDataFrame([("A", 0, dt.date(2024, 1, 1), 0.1)], "symbol string, ord int, date date, ret double")
    with pytest.raises(Exception, match="at least two returns"):
        risk.gram_matrix(returns).collect()
