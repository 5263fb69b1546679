"""Chunked windows equal plain windows over the whole history of a symbol."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlelake.operators import features

T0 = dt.datetime(2024, 1, 1)


def history(spark, seed, n, hot_share=0.5):
    """Irregular bars, half of them of one symbol, with long empty stretches."""
    rng = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        symbol = "HOT" if rng.random() < hot_share else rng.choice("ABC")
        minute = int(rng.choice([rng.uniform(0, 3000), rng.uniform(9000, 20000), rng.uniform(0, 40000)]))
        if (symbol, minute) not in seen:
            seen.add((symbol, minute))
            rows.append((symbol, T0 + dt.timedelta(minutes=minute), rng.uniform(1, 100), float(rng.randint(1, 9))))
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double, volume double")


def rounded(df):
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in map(tuple, df.collect())
    )


def plain():
    return W.partitionBy("symbol").orderBy("timestamp")


@pytest.mark.parametrize("seed, chunk", [(1, "day"), (2, "hour"), (3, "week")])
def test_moving_averages(spark, seed, chunk):
    bars = history(spark, seed, 400)
    want = bars.drop("volume")
    for n in (5, 15):
        want = want.withColumn(f"ma_{n}", F.avg("close").over(plain().rowsBetween(1 - n, 0)))
    assert rounded(features.moving_averages(bars, (5, 15), chunk)) == rounded(want)


@pytest.mark.parametrize("seed, chunk", [(4, "day"), (5, "hour")])
def test_rolling_volatility(spark, seed, chunk):
    bars = history(spark, seed, 300)
    want = (
        bars.drop("volume")
        .withColumn("ret", F.col("close") / F.lag("close").over(plain()) - 1)
        .withColumn("volatility", F.stddev_samp("ret").over(plain().rowsBetween(-6, 0)))
    )
    got = features.rolling_volatility(bars, 7, chunk)
    fill = {"ret": -9.0, "volatility": -9.0}
    assert rounded(got.fillna(fill)) == rounded(want.fillna(fill))


def test_spikes(spark):
    bars = history(spark, 6, 400)
    before = plain().rowsBetween(-10, -1)
    z = lambda c: F.when(
        F.count(c).over(before) == 10,
        F.coalesce(F.try_divide(F.col(c) - F.avg(c).over(before), F.stddev_samp(c).over(before)), F.lit(0.0)),
    ).otherwise(0.0)
    want = bars.withColumn("close_z", z("close")).withColumn("volume_z", z("volume"))
    want = want.where((F.abs("close_z") >= 1.5) | (F.abs("volume_z") >= 1.5))
    got = features.spike_events(bars, 10, 1.5, "hour").drop("price_spike", "volume_spike")
    assert rounded(got) == rounded(want) and got.count() > 0


def test_every_window_is_partitioned_by_chunk(spark):
    """No sort of a whole symbol: only chunk summaries are ordered per symbol alone."""
    plan = features.moving_averages(history(spark, 7, 50))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    for line in physical.splitlines():
        if "Window [avg" in line:
            assert "windowspecdefinition(symbol" in line and "_chunk" in line
