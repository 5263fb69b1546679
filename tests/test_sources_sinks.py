"""File layouts, decoders and sinks."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from candlelake import sinks, sources
from candlelake.plans import etl
from candlelake.plans.scenario import publish, read_results, scenario_counts
from candlelake.schemas import CANDLE_COLUMNS, RESULT_SCHEMAS
from candlelake.session import shared_dir, work_path
from tests.test_clean_quality import T0, candle, frame

CSV_HEADER = (
    "timestamp,open,high,low,close,volume,close_time,quote_asset_volume,number_of_trades,"
    "taker_buy_base_asset_volume,taker_buy_quote_asset_volume,ignore\n"
)


def csv_row(minute, close="1.5"):
    return f"2024-01-01 00:{minute:02d}:00,1,2,1,{close},10,2024-01-01 00:{minute:02d}:59.999,15,3,5,7.5,0\n"


@pytest.mark.parametrize("folder", ["{}", "ticker={}"])
def test_csv_archive_symbol_from_folder(spark, tmp_path, folder):
    for symbol in ("BTCUSDT", "OLDUSDT"):
        home = tmp_path / "archive" / folder.format(symbol)
        home.mkdir(parents=True)
        (home / "part one.csv").write_text(CSV_HEADER + csv_row(0) + csv_row(1, ""))
    df = sources.read_csv_archive(spark, str(tmp_path / "archive"), exclude=["OLDUSDT"])
    assert df.columns == CANDLE_COLUMNS
    rows = df.orderBy("timestamp").collect()
    assert [(r.symbol, r.close) for r in rows] == [("BTCUSDT", 1.5), ("BTCUSDT", None)]
    assert rows[0].close_time == dt.datetime(2024, 1, 1, 0, 0, 59, 999000)


def test_kline_array_with_bad_values(spark):
    good = '[1700000000000,"1.0","1.1","0.9","1.05","100",1700000059999,"105",42,"50","52.5","0"]'
    bad = '[1700000060000,"x","1.1","0.9","1.05","100",1700000119999,"105","many","50","52.5","0"]'
    pages = spark.createDataFrame([("A", f"[{good},{bad}]"), ("B", "[]")], "symbol string, payload string")
    rows = sources.decode_kline_arrays(pages).orderBy("timestamp").collect()
    assert [r.n_bad for r in rows] == [0, 2]
    assert rows[0].timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert (rows[0].number_of_trades, rows[0].close) == (42, 1.05)
    assert rows[1].open is None and rows[1].number_of_trades is None


def test_weight_strings(spark):
    ok = sources.weights_from_string(spark, "p", " btcusdt:0.5 , ETHUSDT : 0.5")
    assert {r.symbol: r.weight for r in ok.collect()} == {"BTCUSDT": 0.5, "ETHUSDT": 0.5}
    last = sources.weights_from_string(spark, "p", "A:0.75,A:0.25")
    assert [r.weight for r in last.collect()] == [0.25]
    for text in ("", "A:0.5", "A:1.5,B:-0.5", ":1.0", "A:one", "A:nan,B:0.5"):
        with pytest.raises(Exception, match="rejected"):
            sources.weights_from_string(spark, "p", text).collect()


def test_weight_string_report(spark):
    texts = [("ok", "A:0.5,B:0.5"), ("sum", "A:0.5"), ("sign", "A:1.5,B:-0.5"), ("name", " :1"), ("text", "A:x")]
    parsed = sources.parse_weight_strings(spark.createDataFrame(texts, "p string, t string"), "p", "t")
    got = {r.portfolio_type: r.is_valid for r in sources.weight_string_checks(parsed).collect()}
    assert got == {"ok": 1, "sum": 0, "sign": 0, "name": 0, "text": 0}


def test_day_bounds(spark):
    df = frame(spark, candle(-1), candle(0), candle(1439), candle(1440))
    assert sources.day_range(df, "2024-01-01").count() == 2


def test_single_day_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    sinks.write_by_date(frame(spark, candle(0), candle(1440), candle(2880)), path)
    day = sources.read_day(spark, path, "2024-01-02")
    assert day.count() == 1
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_column_pruning_of_a_lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    frame(spark, candle(0)).withColumn("date", F.to_date("timestamp")).write.partitionBy("symbol", "date").parquet(path)
    plan = sources.read_partitioned(spark, path).select("symbol", "close")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<close:double>" in plan


def test_append_missing_dates_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert sinks.existing_dates(spark, path) == []
    sinks.append_missing_dates(frame(spark, candle(0)), path)
    both = frame(spark, candle(0), candle(1), candle(1440))
    for _ in range(2):
        sinks.append_missing_dates(both, path)
    assert sinks.existing_dates(spark, path) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert spark.read.parquet(path).count() == 2


def test_hot_date_is_split_over_tasks(spark, tmp_path):
    """One date with nearly all rows becomes several files, other dates one each."""
    path = str(tmp_path / "silver")
    rows = spark.range(200_000).select(
        F.when(F.col("id") < 190_000, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date").alias("date"),
        F.col("id").cast("string").alias("symbol"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        sinks.write_partitioned(rows.repartition(32), path, ["date"], sort=["symbol"])
    finally:
        spark.conf.set(key, before)
    files = spark.read.parquet(path).groupBy("date", F.col("_metadata.file_path")).count()
    per_date = {str(r.date): r.n for r in files.groupBy("date").agg(F.count("*").alias("n")).collect()}
    assert per_date["2024-01-01"] > 1 and per_date["2024-01-02"] == 1
    assert spark.read.parquet(path).count() == 200_000


def test_replace_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "scenario_id string, symbol string, v int")
    sinks.replace_partitions(make([("a", "x", 1), ("a", "y", 1), ("b", "x", 1)]), path, ["scenario_id"])
    sinks.replace_partitions(make([("a", "x", 2)]), path, ["scenario_id"])
    got = sorted((r.scenario_id, r.symbol, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", "x", 2), ("b", "x", 1)]


def test_schema_evolution(spark):
    old = spark.createDataFrame([("a",)], "k string")
    new = spark.createDataFrame([("b", 1)], "k string, simulation_id int")
    rows = {r.k: r.simulation_id for r in sinks.add_missing_columns(old, new).collect()}
    assert rows == {"a": None, "b": 1}


def test_daily_ingest_and_serving(spark, tmp_path):
    bronze, silver, serving = (str(tmp_path / n) for n in ("bronze", "silver", "serving"))
    sinks.write_by_date(
        frame(spark, candle(0), candle(0, " BTCUSDT"), candle(1, open=0.0), candle(1440)), bronze
    )
    for _ in range(2):
        etl.daily_ingest(spark, bronze, silver, "2024-01-01")
    stored = spark.read.parquet(silver)
    assert stored.count() == 1
    etl.serving_load(stored, serving)
    etl.serving_load(stored.withColumn("close", F.lit(11.5)), serving)
    assert [(r.close, str(r.date)) for r in etl.serving_view(spark, serving).collect()] == [(11.5, "2024-01-01")]
    assert spark.read.parquet(serving).count() == 2
    etl.compact_serving(spark, serving, "202401")
    assert [r.close for r in spark.read.parquet(serving).collect()] == [11.5]


def test_bulk_load(spark, tmp_path):
    archive, lake, silver = (str(tmp_path / n) for n in ("csv", "lake", "silver"))
    home = tmp_path / "csv" / "AAA"
    home.mkdir(parents=True)
    (home / "x.csv").write_text(CSV_HEADER + csv_row(0) + csv_row(0) + csv_row(1))
    later = frame(spark, candle(0, "BBB"), candle(1440, "BBB")).withColumn("date", F.to_date("timestamp"))
    later.write.partitionBy("symbol", "date").parquet(lake)
    etl.bulk_load(spark, archive, lake, silver)
    assert spark.read.parquet(silver).count() == 4
    etl.bulk_load(spark, archive, lake, silver, start="2024-01-02", append=True)
    assert spark.read.parquet(silver).count() == 5


def test_published_scenario_is_replaced_not_added(spark, tmp_path):
    root = str(tmp_path / "results")
    def tables(scenario, value):
        return {
            "portfolio_simulations": spark.createDataFrame(
                [(scenario, i, value, 1.0, 1.0, 0.5, 0, T0) for i in range(3)],
                RESULT_SCHEMAS["portfolio_simulations"],
            )
        }
    publish(tables("one", 1.0), root, "one")
    publish(tables("two", 1.0), root, "two")
    publish(tables("one", 2.0), root, "one")
    stored = read_results(spark, root, "portfolio_simulations")
    assert stored.columns[:2] == ["scenario_id", "simulation_id"]
    assert stored.count() == 6
    assert {r.annualized_return for r in stored.where("scenario_id = 'one'").collect()} == {2.0}


class _Session:
    """The parts of a session that the folder choice looks at."""

    def __init__(self, local, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        context = SimpleNamespace(sc=lambda: SimpleNamespace(isLocal=lambda: local))
        self.sparkContext = SimpleNamespace(_jsc=context, applicationId="app-1")


def test_work_folder_follows_the_session_setting():
    assert shared_dir(_Session(False, "hdfs://lake/work/")) == "hdfs://lake/work"
    assert work_path(_Session(False, "hdfs://lake/work"), "x").startswith("hdfs://lake/work/candlelake/x-")
    local = _Session(True)
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(False))
