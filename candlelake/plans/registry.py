"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake import sources, streaming
from candlelake.operators import bars, bitmaps, clean, features, panel, portfolio, quality, setops, snapshots, upsert
from candlelake.operators.candidates import candidate_weights as weights_of_legs
from candlelake.operators.candidates import best_candidate, feasible_range
from candlelake.operators.risk import full_matrix, gram_matrix, upper_matrix
from candlelake.plans import bindings as b
from candlelake.plans import dashboard, etl
from candlelake.plans.scenario import Scenario, ScenarioConfig, publish, read_results, scenario_counts, stop_reason
from candlelake.plans.staging import staged
from candlelake.schemas import CANDLE_COLUMNS, CANDLE_SCHEMA
from candlelake.session import use_utc, work_path
from candlelake import sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; the oracle SQL uses the same values.
NOW = "2024-01-31 00:00:00"
DAY = "2024-01-15"
BACKFILL_START = "2024-01-05"
SPLIT = "2024-01-15 12:00:00"
# ends of two batch loads; the stream stands still in between, at the middle of its messages
SETTLED = ("2024-01-10", "2024-01-20")
EXCLUDED = ("error", "signup")
CONFIG = ScenarioConfig(
    scenario_id="weekly_brands",
    scenario_name="Weekly brands",
    investor_name="desk",
    baseline_label="50% BRAND#10 / 50% BRAND#2",
    benchmark_symbol="BRAND#10",
    lookback=365,
    buffer=45,
    min_history=180,
    period_days=7,
    periods_per_year=52,
)
BASELINE_TEXT = "BRAND#10:0.5,BRAND#2:0.5"
EVENT_LOOKBACK, EVENT_MIN_HISTORY = 365, 15
# recent windows in days, and the returns they must give
RECENT_DAYS, SHORT_HISTORY = (120, 2), 3


def query(build: Query) -> Query:
    """Register under the function's name; results get plain comparable types."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(use_utc(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places, show dates as text, drop the time zone of times."""
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            # halves are common and come out a bit lower or higher by the order of a sum, so the edge
            # between two roundings lies beside them, here as in the SQL twins
            return (F.round(column * 1e6 + 0.01) / 1e6).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


# --- sources -----------------------------------------------------------------


@query
def csv_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as one CSV folder per ticker, read back with the symbol from the path."""
    root = work_path(spark, "csv")
    minute = b.candles(spark, sf_dir)
    rows = minute.drop("symbol").columns
    (
        minute.withColumn("ticker", F.col("symbol"))
        .withColumn("ignore", F.lit("0"))
        .select(*rows, "ignore", "ticker")
        .hint("rebalance", F.col("ticker"))
        .write.partitionBy("ticker")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS")
        .csv(root)
    )
    return sources.read_csv_archive(spark, root, exclude=EXCLUDED)


def _lake(spark: SparkSession, sf_dir: str, by: list[str]) -> str:
    root = work_path(spark, "lake")
    dated = b.candles(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    sinks.write_partitioned(dated, root, by)
    return root


@query
def hive_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_partitioned(spark, _lake(spark, sf_dir, ["symbol", "date"]))


@query
def single_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_day(spark, _lake(spark, sf_dir, ["date"]), DAY)


@query
def daily_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days written in the daily layout, one of them twice; the other is read back."""
    root = work_path(spark, "daily")
    minute = b.candles(spark, sf_dir)
    for day in (BACKFILL_START, DAY, DAY):
        sinks.write_daily_folder(minute, root, day)
    return sources.read_daily_folder(spark, root, DAY)


@query
def date_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.from_date(b.candles(spark, sf_dir), DAY)


@query
def kline_array_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars packed into pages of positional arrays, one page per symbol and hour, and decoded."""
    slots = F.array(
        F.unix_millis("timestamp").cast("string"),
        *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.unix_millis("close_time").cast("string"),
        *[
            F.col(c).cast("string")
            for c in (
                "quote_asset_volume",
                "number_of_trades",
                "taker_buy_base_asset_volume",
                "taker_buy_quote_asset_volume",
            )
        ],
        F.lit("0"),
    )
    pages = (
        b.candles(spark, sf_dir)
        .groupBy("symbol", F.date_trunc("hour", "timestamp").alias("page"))
        .agg(F.to_json(F.collect_list(slots)).alias("payload"))
    )
    return sources.decode_kline_arrays(pages)


@query
def kline_message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
    inner = F.struct(
        F.unix_millis("timestamp").alias("t"),
        *[F.col(c).cast("string").alias(k) for k, c in text.items()],
    )
    messages = b.candles(spark, sf_dir).select(
        "symbol", F.to_json(F.struct(inner.alias("k"))).alias("value")
    )
    return sources.decode_kline_messages(messages, keep=("symbol",))


@query
def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, symbols and files per date folder, from the file-level counts."""
    lake = spark.read.parquet(_lake(spark, sf_dir, ["date"]))
    return sources.partition_stats(lake)


@query
def file_level_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the per-file row counts of a lake."""
    counts = sources.file_row_counts(spark.read.parquet(_lake(spark, sf_dir, ["date"])))
    return counts.agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))


@query
def footer_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bounds per date folder, answered by the footers of the files."""
    root = work_path(spark, "lake")
    dated = b.candles(spark, sf_dir).withColumn("date", F.to_date("timestamp")).withColumn("open_ms", F.unix_millis("timestamp"))
    sinks.write_partitioned(dated, root, ["date"])
    return sources.footer_stats(spark, root, ["open_ms", "number_of_trades", "close"], ["date"])


@query
def footer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bounds of whole given tables, from their footers alone."""
    keys = {"events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}
    parts = [
        sources.footer_stats(spark, f"{sf_dir}/{name}.parquet", [key]).toDF("n_rows", "first_key", "last_key").withColumn("table_name", F.lit(name))
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def lake_universe_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of the symbols a stored universe holds; the folders of the others are pruned when the job runs."""
    root = _lake(spark, sf_dir, ["symbol", "date"])
    symbols = staged(b.numbered_symbols(b.ticks(spark, sf_dir)), "universe")
    return sources.read_universe(spark, root, symbols.where(F.col("ord") >= 2))


@query
def json_lines_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "json")
    closes = bars.daily_close(b.ticks(spark, sf_dir), "price", "tick_id")
    closes.write.json(root)
    return sources.read_json_lines(spark, root, "symbol string, date date, close double")


def _weight_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weight string per day: the share of every symbol in the day's ticks."""
    counts = b.ticks(spark, sf_dir).groupBy(
        F.to_date("timestamp").alias("date"), "symbol"
    ).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("date").agg(F.sum("n").alias("total"))
    share = F.round(F.col("n") / F.col("total"), 4).cast("string")
    item = F.struct("symbol", F.concat(F.lit(" "), "symbol", F.lit(": "), share).alias("text"))
    ordered = F.transform(F.sort_array(F.collect_list(item)), lambda i: i["text"])
    return (
        counts.join(total, "date")
        .groupBy(F.col("date").cast("string").alias("portfolio_type"))
        .agg(F.concat_ws(",", ordered).alias("text"))
    )


@query
def sparse_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sources.parse_weight_strings(_weight_texts(spark, sf_dir), "portfolio_type", "text")
    checks = sources.weight_string_checks(parsed).select("portfolio_type", "is_valid")
    return sources.normalise_weights(parsed).join(checks, "portfolio_type")


@query
def dense_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe of events with the parsed weights of one configured portfolio."""
    universe = b.numbered_symbols(b.ticks(spark, sf_dir).select(F.upper("symbol").alias("symbol")))
    sparse = sources.weights_from_string(spark, "baseline", " click:0.25,view :0.25,click:0.5,nowhere:0")
    return portfolio.dense_weights(universe, sparse, "baseline")


@query
def time_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks from the start date to 23:59 of the day before the newest one."""
    t = b.ticks(spark, sf_dir)
    today = t.agg(F.max(F.to_date("timestamp"))).scalar()
    return sources.backfill_range(t, BACKFILL_START, today).select("tick_id", "symbol", "timestamp", "price")


@query
def day_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.day_range(b.ticks(spark, sf_dir), DAY).select("tick_id", "symbol", "timestamp", "price")


@query
def optional_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes with only a start, only an end, and no bound."""
    closes = bars.daily_close(b.ticks(spark, sf_dir), "price", "tick_id")
    cases = {"start": (DAY, None), "end": (None, DAY), "none": (None, None)}
    parts = [
        sources.within_dates(closes, *bounds).withColumn("bounds", F.lit(name))
        for name, bounds in cases.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- sinks -------------------------------------------------------------------


@query
def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overwrites of the same folder leave the second."""
    target = work_path(spark, "silver")
    minute = b.candles(spark, sf_dir)
    sinks.write_by_date(minute.where(F.col("timestamp") < F.lit(SPLIT).cast("timestamp")), target)
    sinks.write_by_date(minute, target)
    return spark.read.parquet(target)


@query
def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves appended give the whole."""
    target = work_path(spark, "silver")
    early = F.col("timestamp") < F.lit(SPLIT).cast("timestamp")
    minute = b.candles(spark, sf_dir)
    sinks.write_by_date(minute.where(early), target, "append")
    sinks.write_by_date(minute.where(~early), target, "append")
    return spark.read.parquet(target)


@query
def append_missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun over all dates adds only the dates the target lacks."""
    target = work_path(spark, "silver")
    minute = b.candles(spark, sf_dir)
    sinks.append_missing_dates(minute.where(F.to_date("timestamp") <= F.lit(DAY).cast("date")), target)
    sinks.append_missing_dates(minute, target)
    sinks.append_missing_dates(minute, target)
    return spark.read.parquet(target)


@query
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with wrong closes is repaired for a range of dates only; a date that has no candles any more vanishes."""
    target = work_path(spark, "silver")
    minute = b.candles(spark, sf_dir)
    sinks.write_by_date(minute.withColumn("close", F.col("close") + 1), target)
    for _ in range(2):
        etl.backfill(minute.where(F.to_date("timestamp") != F.lit(BACKFILL_START).cast("date")), target, BACKFILL_START, DAY)
    return spark.read.parquet(target).select("timestamp", "symbol", "close", "date")


@query
def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and closes per month folder of the orders' daily closes."""
    target = work_path(spark, "months")
    sinks.write_partitioned(sinks.with_month(b.priority_daily(spark, sf_dir)), target, ["month"], sort=("symbol", "date"))
    stored = spark.read.schema("symbol string, date date, close double, month string").parquet(target)
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), F.max("close").alias("max_close"))


@query
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = b.ticks(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    kept = upsert.latest_wins(hourly, ["symbol", "timestamp"], "tick_id")
    return kept.select("symbol", "timestamp", "tick_id", "price")


@query
def batch_over_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream rows exist for all minutes, batch rows up to the split; batch wins."""
    minute = b.candles(spark, sf_dir)
    batch = minute.where(F.col("timestamp") < F.lit(SPLIT).cast("timestamp"))
    stream = minute.withColumn("close", F.col("close") + 1)
    return upsert.batch_over_stream(batch, stream).select("timestamp", "symbol", "close", "source")


@query
def replace_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scenarios are stored; one is written again, one comes out empty, the third stays."""
    root = work_path(spark, "scenarios")
    closes = b.daily_panel(spark, sf_dir)
    tagged = lambda name, factor: closes.select(
        F.lit(name).alias("scenario_id"), "symbol", "date", (F.col("close") * factor).alias("close")
    )
    first = reduce(DataFrame.unionByName, [tagged(name, 1.0) for name in ("first", "second", "third")])
    sinks.replace_partitions(first, root, ["scenario_id"])
    sinks.replace_partitions(tagged("second", 2.0), root, ["scenario_id"], ["scenario_id=second"])
    sinks.replace_partitions(tagged("third", 2.0).limit(0), root, ["scenario_id"], ["scenario_id=third"])
    return spark.read.parquet(root)


@query
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table over a date-partitioned lake, read with SQL."""
    root = _lake(spark, sf_dir, ["date"])
    name = "candles_" + root[-12:]
    schema = T.StructType([*CANDLE_SCHEMA, T.StructField("date", T.DateType())])
    sinks.register_external_table(spark, name, root, schema, ["date"])
    return spark.sql(
        f"SELECT date, symbol, count(*) AS n_rows, max(high) AS high FROM {name} GROUP BY date, symbol"
    )


@query
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table without a column united with rows that have it, plus derived columns."""
    closes = b.daily_panel(spark, sf_dir)
    cut = F.lit(DAY).cast("date")
    old = closes.where(F.col("date") < cut)
    new = closes.where(F.col("date") >= cut).withColumn("simulation_id", F.lit(7))
    united = sinks.add_missing_columns(old, new)
    return united.select(
        "symbol",
        "date",
        "close",
        F.coalesce("simulation_id", F.lit(-1)).alias("simulation_id"),
        F.abs(100 - F.col("close")).alias("abs_distance"),
    )


@query
def load_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = b.candles(spark, sf_dir)
    return sinks.load_delta(minute.where(F.col("timestamp") < F.lit(SPLIT).cast("timestamp")), minute)


@query
def serving_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candles are loaded twice into the serving table; its view shows each once."""
    target = work_path(spark, "serving")
    minute = staged(b.candles(spark, sf_dir), "minute")
    etl.serving_load(minute, target)
    etl.serving_load(minute, target)
    return etl.serving_view(spark, target).select(*CANDLE_COLUMNS, "date")


# --- cleaning and quality ----------------------------------------------------


@query
def clean_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_candles(b.dirty_candles(spark, sf_dir))


@query
def quality_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_strict(clean.clean_candles(b.dirty_candles(spark, sf_dir)))


@query
def quality_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_weak(clean.clean_candles(b.dirty_candles(spark, sf_dir)))


@query
def bulk_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, each cleaned, united and filtered; keys in both stay twice."""
    dirty = b.dirty_candles(spark, sf_dir)
    second = b.candles(spark, sf_dir).where(F.col("timestamp") >= F.lit(SPLIT).cast("timestamp"))
    target = work_path(spark, "silver")
    sinks.write_by_date(etl.silver_candles(dirty, second), target)
    return spark.read.parquet(target)


@query
def cross_source_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = b.dirty_candles(spark, sf_dir)
    second = b.candles(spark, sf_dir).where(F.col("timestamp") >= F.lit(SPLIT).cast("timestamp"))
    return etl.silver_candles(dirty, second, dedup=True)


@query
def load_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving types, a constant tag and a 0/1 flag."""
    rows = clean.serving_projection(b.candles(spark, sf_dir))
    return rows.withColumn("origin", F.lit("events")).withColumn(
        "rising", (F.col("close") > F.col("open")).cast("int")
    )


@query
def symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = clean.select_symbols(b.ticks(spark, sf_dir), ["click", "view"])
    return chosen.select("symbol", "timestamp", "tick_id", "price").orderBy("timestamp", "symbol")


@query
def symbol_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean.exclude_symbols(b.ticks(spark, sf_dir), EXCLUDED)
    return kept.select("symbol", "timestamp", "tick_id", "price")


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows in a total order."""
    t = b.ticks(spark, sf_dir)
    return t.select("symbol", "timestamp", "tick_id", "price").orderBy("timestamp", "tick_id").limit(20)


@query
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gaps(b.candles(spark, sf_dir, "hour"), 3600, chunk="week")


@query
def minute_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gaps(b.candles(spark, sf_dir), 60, chunk="day")


@query
def missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_slots(b.candles(spark, sf_dir), 60)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = b.dirty_candles(spark, sf_dir).withColumn("symbol", F.trim("symbol"))
    return quality.duplicate_keys(dirty)


@query
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = b.dirty_candles(spark, sf_dir)
    return quality.range_violations(dirty.withColumn("symbol", F.trim("symbol")))


@query
def bitmap_missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing minutes from the stored bitmaps of two loads that overlap."""
    minute = b.candles(spark, sf_dir)
    split, day = F.lit(SPLIT).cast("timestamp"), F.lit(DAY).cast("timestamp")
    loads = [minute.where(F.col("timestamp") < split), minute.where(F.col("timestamp") >= day)]
    stored = [staged(bitmaps.slot_bitmaps(load, 60), "bitmaps") for load in loads]
    return bitmaps.missing_slots(bitmaps.merged(*stored), 60)


@query
def bitmap_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.gaps(bitmaps.slot_bitmaps(b.candles(spark, sf_dir), 60), 60)


@query
def bitmap_common_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates on which all order priorities have a close."""
    closes = staged(b.priority_daily(spark, sf_dir), "closes")
    return bitmaps.common_dates(bitmaps.date_bitmaps(closes), b.numbered_symbols(closes))


@query
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(b.ticks(spark, sf_dir), F.lit(NOW).cast("timestamp"))


@query
def ingestion_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingestion_lag(b.ticks(spark, sf_dir), F.lit(NOW).cast("timestamp"))


@query
def count_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = b.dirty_candles(spark, sf_dir)
    return quality.count_delta(dirty, quality.quality_strict(clean.clean_candles(dirty)))


@query
def guard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = staged(b.priority_daily(spark, sf_dir), "closes")
    known = b.numbered_symbols(closes)
    # a listed symbol that has no closes yet
    listed = known.unionByName(spark.range(1).select(F.lit("0-NEW").alias("symbol"), F.lit(-1).alias("ord")))
    dates = panel.common_dates(closes, known)
    aligned = panel.aligned_panel(closes, known, CONFIG.lookback, CONFIG.min_history)
    return quality.guard_report(closes, listed, dates, aligned, "6-NONE", CONFIG.min_history)


@query
def strict_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a strict run says for sound inputs and for inputs that break one guard each."""
    closes = staged(b.brand_weekly(spark, sf_dir), "closes")
    known = b.brands(spark, sf_dir)
    baseline = sources.weights_from_string(spark, "baseline", BASELINE_TEXT)
    broken = closes.withColumn("close", F.when(F.col("symbol") == "BRAND#10", 0.0).otherwise(F.col("close")))
    heavy = sources.weights_from_string(spark, "baseline", "BRAND#10:0.5,BRAND#2:0.75")
    inputs = {
        "sound": (closes, baseline, CONFIG),
        "benchmark": (closes, baseline, replace(CONFIG, benchmark_symbol="BRAND#0")),
        "history": (closes, baseline, replace(CONFIG, min_history=100_000)),
        "price": (broken, baseline, CONFIG),
        "weights": (closes, heavy, CONFIG),
    }
    said = [(name, stop_reason(prices, known, weights, config)) for name, (prices, weights, config) in inputs.items()]
    return spark.createDataFrame(said, "inputs string, reason string")


@query
def feasible_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feasible numbers of assets for the brand universe."""
    n = F.count(F.lit(1)).cast("int")
    size = b.brands(spark, sf_dir).agg(n.alias("n_assets"))
    low, high = feasible_range(F.col("n_assets"), CONFIG.min_active, CONFIG.max_active, CONFIG.min_weight)
    return size.select("n_assets", low.alias("min_active"), high.alias("max_active"))


# --- daily closes, bars and features -----------------------------------------


@query
def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = bars.daily_close(b.ticks(spark, sf_dir), "price", "tick_id")
    return closes.orderBy("date", "symbol")


@query
def series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.series_bounds(b.ticks(spark, sf_dir), "price", "tick_id")


@query
def rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.rollup(b.candles(spark, sf_dir), "hour")


@query
def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.rollup(b.candles(spark, sf_dir), "day")


@query
def top_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.top_symbols(b.candles(spark, sf_dir, "hour"), 3)


@query
def bar_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.bar_returns(b.candles(spark, sf_dir))


@query
def moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.moving_averages(b.candles(spark, sf_dir))


@query
def rolling_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.rolling_volatility(b.candles(spark, sf_dir, "hour"), chunk="week")


@query
def spike_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.spike_events(b.candles(spark, sf_dir, "hour"), chunk="week")


@query
def stored_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of outlier events after loads of three ranges of dates that overlap, the first of them over wrong prices."""
    target = work_path(spark, "spikes")
    hourly = b.candles(spark, sf_dir, "hour")
    wrong = hourly.withColumn("close", F.when(F.hour("timestamp") == 7, F.col("close") * 50).otherwise(F.col("close")))
    etl.store_spikes(wrong, target, "2024-01-01", DAY, chunk="week")
    etl.store_spikes(hourly, target, DAY, NOW[:10], chunk="week")
    etl.store_spikes(hourly, target, "2024-01-01", DAY, chunk="week")
    schema = features.spike_events(hourly, chunk="week").schema
    return spark.read.schema(schema).parquet(target).drop("date")


# --- symbol sets -------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = b.user_ticks(spark, sf_dir)
    split = F.lit(SPLIT).cast("timestamp")
    return setops.symbols_of(t.where(F.col("timestamp") < split)), setops.symbols_of(t.where(F.col("timestamp") >= split))


@query
def ticker_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _halves(spark, sf_dir)
    return left.unionByName(right).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_sources"))


@query
def ticker_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.common_symbols(*_halves(spark, sf_dir))


@query
def ticker_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.one_sided_symbols(*_halves(spark, sf_dir))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"), F.col("c_custkey").alias("ord")
    )


@query
def fresh_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.fresh_symbols(b.user_ticks(spark, sf_dir))


@query
def usable_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.usable_universe(
        _customers(spark, sf_dir), setops.fresh_symbols(b.user_ticks(spark, sf_dir))
    )


@query
def skipped_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.skipped_symbols(
        _customers(spark, sf_dir), setops.fresh_symbols(b.user_ticks(spark, sf_dir))
    )


# --- panel and moments -------------------------------------------------------


@query
def aligned_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = staged(b.priority_daily(spark, sf_dir), "closes")
    return panel.aligned_panel(closes, b.numbered_symbols(closes), CONFIG.lookback, CONFIG.min_history)


@query
def panel_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = staged(b.priority_daily(spark, sf_dir), "closes")
    return panel.panel_with_fallback(
        closes, b.numbered_symbols(closes), CONFIG.lookback, CONFIG.buffer, CONFIG.min_history
    )


@query
def panel_fallback_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recent window that is long enough, though shorter than the look-back, and one that is too short: all history then."""
    closes = staged(b.priority_daily(spark, sf_dir), "closes")
    known = b.numbered_symbols(closes)
    parts = [
        panel.panel_with_fallback(closes, known, CONFIG.lookback, days - CONFIG.lookback, SHORT_HISTORY).withColumn("days", F.lit(days))
        for days in RECENT_DAYS
    ]
    return reduce(DataFrame.unionByName, parts)


def _event_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = staged(b.daily_panel(spark, sf_dir), "closes")
    aligned = panel.aligned_panel(
        closes, b.numbered_symbols(closes), EVENT_LOOKBACK, EVENT_MIN_HISTORY
    )
    return panel.asset_returns(aligned)


@query
def asset_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_returns(spark, sf_dir)


@query
def return_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.return_stats(_event_returns(spark, sf_dir))


@query
def covariance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = full_matrix(upper_matrix(_event_returns(spark, sf_dir)))
    return matrix.select("symbol_x", "symbol_y", "covariance")


@query
def gram_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_matrix(gram_matrix(_event_returns(spark, sf_dir))).select("symbol_x", "symbol_y", "covariance", "correlation")


@query
def two_asset_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value path of half and half in two event types."""
    returns = _event_returns(spark, sf_dir)
    weights = sources.weights_from_string(spark, "baseline", "CLICK:0.5,VIEW:0.5")
    lower = weights.withColumn("symbol", F.lower("symbol"))
    return portfolio.backtest(portfolio.portfolio_returns(returns, lower), CONFIG.initial_capital)


@query
def value_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value, peak and drawdown after every minute bar of all symbols, from a capital of 1."""
    returns = features.bar_returns(b.candles(spark, sf_dir))
    paths = portfolio.value_paths(returns, 1.0, F.date_trunc("day", "timestamp"))
    return paths.select("symbol", "timestamp", "portfolio_value", "peak", "cumulative_return", "drawdown")


# --- portfolios: one scenario over the brands --------------------------------


def _scenario(spark: SparkSession, sf_dir: str, config: ScenarioConfig = CONFIG) -> Scenario:
    """Closes are aggregated from the line items once and stored; the rest reads them."""
    closes = staged(b.brand_weekly(spark, sf_dir), "closes")
    baseline = sources.weights_from_string(spark, "baseline", BASELINE_TEXT)
    return Scenario(closes, b.brands(spark, sf_dir), baseline, config).prepare()


def _simulated(spark: SparkSession, sf_dir: str, config: ScenarioConfig = CONFIG) -> Scenario:
    return _scenario(spark, sf_dir, config).simulate()


@query
def correlation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scenario(spark, sf_dir).correlation_rows()


@query
def candidate_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _scenario(spark, sf_dir).simulate(stage=False)
    return weights_of_legs(run.legs, run.universe)


@query
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _simulated(spark, sf_dir).simulation_rows()


@query
def optimal_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_candidate(_simulated(spark, sf_dir).scores)


@query
def portfolio_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _simulated(spark, sf_dir)
    return run.series(run.weights())


@query
def portfolio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _simulated(spark, sf_dir)
    return run.metric_rows(staged(run.weights(), "weights"))


@query
def portfolio_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _simulated(spark, sf_dir)
    return run.backtest_rows(run.weights())


@query
def diversification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of the three portfolios, of equal weights and of one without any holding."""
    run = _simulated(spark, sf_dir)
    size = run.universe.agg(F.count(F.lit(1))).scalar()
    edge = [
        run.universe.select(F.lit("equal").alias("portfolio_type"), "symbol", "ord", (1.0 / size).alias("weight")),
        run.universe.select(F.lit("empty").alias("portfolio_type"), "symbol", "ord", F.lit(0.0).alias("weight")),
    ]
    weights = staged(reduce(DataFrame.unionByName, edge, run.weights()), "weights")
    return portfolio.diversification(weights, run.upper)


@query
def ranked_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _simulated(spark, sf_dir)
    rows = run.weight_rows(run.weights())
    return rows.withColumn("simulation_id", F.coalesce("simulation_id", F.lit(-1)))


@query
def scenario_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scenario(spark, sf_dir).scenario_rows()


def _published(spark: SparkSession, sf_dir: str, *first: ScenarioConfig) -> str:
    """All six tables of two scenarios with different settings in one store, after those of ``first``."""
    root = work_path(spark, "results")
    other = replace(CONFIG, scenario_id="other", risk_free_rate=0.01, seed=7, simulations=200)
    for config in (*first, other, CONFIG):
        publish(_simulated(spark, sf_dir, config).tables(), root, config.scenario_id)
    return root


def _stored(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    return [read_results(spark, root, name) for name in names]


@query
def publish_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per result table after the scenario was published over an earlier run of itself."""
    earlier = replace(CONFIG, seed=9, simulations=200)
    return scenario_counts(spark, _published(spark, sf_dir, earlier), CONFIG.scenario_id)


@query
def panel_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    (weights,) = _stored(spark, _published(spark, sf_dir), "portfolio_weights")
    return dashboard.allocation(weights, CONFIG.scenario_id, "optimized")


@query
def panel_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    (metrics,) = _stored(spark, _published(spark, sf_dir), "portfolio_metrics")
    return dashboard.kpis(metrics, CONFIG.scenario_id)


@query
def panel_value_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    (series,) = _stored(spark, _published(spark, sf_dir), "portfolio_backtest_series")
    return dashboard.value_path(series, CONFIG.scenario_id, ["baseline", "optimized", "benchmark"])


@query
def panel_corr_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("portfolio_correlation_matrix", "portfolio_weights")
    matrix, weights = _stored(spark, _published(spark, sf_dir), *names)
    return dashboard.correlation_subset(matrix, weights, CONFIG.scenario_id, ["BRAND#10", "BRAND#2"])


@query
def panel_search_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    (simulations,) = _stored(spark, _published(spark, sf_dir), "portfolio_simulations")
    return dashboard.search_space(simulations, CONFIG.scenario_id)


# --- streaming ---------------------------------------------------------------


# spans of time that land one after the other, and the files of each
LANDINGS, FILES = 4, 2


def _land(messages: DataFrame, root: str, spans: range, late: bool = False) -> None:
    """Append messages to the landed text files, a span of time after the other.

    ``late`` sends messages of the first span once more with the last one: long after the watermark.
    """
    seconds = F.get_json_object("value", "$.open_time").cast("long") / 1000
    first, last = F.unix_seconds(F.lit("2024-01-01").cast("timestamp")), F.unix_seconds(F.lit(NOW).cast("timestamp"))
    share = (seconds - first) / (last - first) * LANDINGS
    span = F.greatest(F.lit(0), F.least(F.floor(F.coalesce(share, F.lit(0))).cast("int"), F.lit(LANDINGS - 1)))
    for number in spans:
        due = span == number
        if late and number == LANDINGS - 1:
            due = due | ((span == 0) & share.isNotNull())
        messages.where(due).coalesce(FILES).write.mode("append").text(root)


def _landed(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """The candle messages as landed text files, read in several micro-batches and parsed."""
    root = work_path(spark, "messages")
    _land(staged(b.stream_messages(spark, sf_dir), "lines"), root, range(LANDINGS), late)
    return streaming.parse_messages(streaming.message_stream(spark, root, FILES))


def _drain(
    spark: SparkSession, stream: DataFrame, partition_by: tuple[str, ...] = (), checkpoint: str | None = None
) -> DataFrame:
    target = work_path(spark, "stream")
    streaming.run_available(
        stream,
        target,
        checkpoint or work_path(spark, "checkpoint"),
        partition_by,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    return spark.read.schema(stream.schema).parquet(target)


@query
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed, well-formed candles, archived by symbol, year and month."""
    closed = streaming.archive_columns(streaming.closed_candles(_landed(spark, sf_dir)))
    return _drain(spark, closed, ("symbol", "year", "month"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats are dropped across micro-batches, those that come after the watermark too."""
    return _drain(spark, streaming.dedup_stream(streaming.closed_candles(_landed(spark, sf_dir, late=True))))


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stopped query goes on with its checkpoint: what landed before and after the stop counts once."""
    root, target, checkpoint = (work_path(spark, name) for name in ("messages", "stream", "checkpoint"))
    lines = staged(b.stream_messages(spark, sf_dir), "lines")
    half = LANDINGS // 2
    for spans in (range(half), range(half, LANDINGS), range(0)):
        _land(lines, root, spans)
        closed = streaming.closed_candles(streaming.parse_messages(streaming.message_stream(spark, root, FILES)))
        streaming.run_available(
            streaming.dedup_stream(closed), target, checkpoint, state_partitions=spark.sparkContext.defaultParallelism
        )
    return spark.read.schema(closed.schema).parquet(target)


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours closed by the watermark, and from the state store those that are still open when the stream ends."""
    checkpoint = work_path(spark, "checkpoint")
    deduplicated = streaming.dedup_stream(streaming.closed_candles(_landed(spark, sf_dir)))
    emitted = _drain(spark, streaming.hourly_stream(deduplicated, late_limit=None), checkpoint=checkpoint)
    return emitted.unionByName(streaming.open_hours(spark, checkpoint))


@query
def stream_hourly_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a stop in the middle of the data: open hours go on from the state, and no hour is emitted twice."""
    root, target, checkpoint = (work_path(spark, name) for name in ("messages", "stream", "checkpoint"))
    lines = staged(b.stream_messages(spark, sf_dir), "lines")
    half = LANDINGS // 2
    for spans in (range(half), range(half, LANDINGS), range(0)):
        _land(lines, root, spans)
        closed = streaming.closed_candles(streaming.parse_messages(streaming.message_stream(spark, root, FILES)))
        hours = streaming.hourly_stream(streaming.dedup_stream(closed), late_limit=None)
        streaming.run_available(hours, target, checkpoint, state_partitions=spark.sparkContext.defaultParallelism)
    emitted = spark.read.schema(hours.schema).parquet(target)
    return emitted.unionByName(streaming.open_hours(spark, checkpoint))


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the metrics that the archiving job itself observed, with a stop and a restart between."""
    root, target, metrics, checkpoint = (work_path(spark, name) for name in ("messages", "archive", "metrics", "checkpoint"))
    lines = staged(b.stream_messages(spark, sf_dir), "lines")
    half = LANDINGS // 2
    for spans in (range(half), range(half, LANDINGS), range(0)):
        _land(lines, root, spans)
        parsed = streaming.parse_messages(streaming.message_stream(spark, root, FILES))
        streaming.archive_with_metrics(parsed, target, metrics, checkpoint, F.lit(NOW).cast("timestamp"))
    stored = spark.read.parquet(metrics)
    names = ("n_rows", "n_malformed", "n_unclosed", "n_violations")
    closed = (F.sum("n_stored") + F.sum("n_duplicates")).alias("n_closed")
    return stored.agg(*(F.sum(n).alias(n) for n in names), closed, F.max("newest").alias("newest"), F.min("lag_seconds").alias("lag_seconds"))


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of two batch loads, one of them run twice under its id."""
    dirty, metrics = b.dirty_candles(spark, sf_dir), work_path(spark, "metrics")
    cleaned = lambda rows: quality.quality_strict(clean.clean_candles(rows))
    hourly = b.dirty_candles(spark, sf_dir, "hour")
    for run_id, rows in (("minutes", dirty), ("hours", hourly), ("hours", hourly)):
        table = streaming.load_with_metrics(
            rows, cleaned, lambda df: sinks.write_by_date(df, work_path(spark, "silver")), metrics, run_id
        )
    return table.withColumn("run_id", F.col("run_id").cast("string"))


@query
def stream_unsettled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream stores beside a batch table that grows while the stream stands still; late messages of settled keys come at the end."""
    root, target, settled, checkpoint = (work_path(spark, name) for name in ("messages", "stream", "settled", "checkpoint"))
    lines = staged(b.stream_messages(spark, sf_dir), "lines")
    minute, half = b.candles(spark, sf_dir), LANDINGS // 2
    until = ["2024-01-01", *SETTLED]
    for spans, low, high in zip((range(half), range(half, LANDINGS)), until, until[1:]):
        sinks.write_by_date(minute.where((F.col("timestamp") >= low) & (F.col("timestamp") < high)), settled, "append")
        _land(lines, root, spans, late=True)
        closed = streaming.closed_candles(streaming.parse_messages(streaming.message_stream(spark, root, FILES)))
        streaming.land_unsettled(
            streaming.dedup_stream(closed), settled, target, checkpoint, state_partitions=spark.sparkContext.defaultParallelism
        )
    return spark.read.parquet(target).select("symbol", "timestamp", "close")


@query
def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving averages of minute bars, computed as they arrive over four runs of the stream."""
    root, target, tails, checkpoint = (work_path(spark, name) for name in ("messages", "features", "tails", "checkpoint"))
    lines = staged(b.stream_messages(spark, sf_dir), "lines")
    columns = {f"ma_{n}": lambda w, n=n: F.avg("close").over(w.rowsBetween(1 - n, 0)) for n in (5, 15)}
    for number in range(LANDINGS):
        _land(lines, root, range(number, number + 1))
        closed = streaming.closed_candles(streaming.parse_messages(streaming.message_stream(spark, root)))
        bars_ = streaming.dedup_stream(closed).select("timestamp", "symbol", "close")
        streaming.store_features(
            bars_, columns, 14, target, tails, checkpoint, state_partitions=spark.sparkContext.defaultParallelism
        )
    return spark.read.parquet(target).select("symbol", "timestamp", "close", "ma_5", "ma_15", "is_late")


@query
def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_path(spark, "metrics")
    streaming.count_malformed(_landed(spark, sf_dir), target, work_path(spark, "checkpoint"))
    stored = spark.read.parquet(target)
    return stored.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_malformed").alias("n_malformed"))


@query
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per symbol, those written before their candle was complete, and the sum of completion times in ms.

    The last is write time less latency, so it is right only if latency is measured from the message's own time.
    """
    closed = streaming.closed_candles(_landed(spark, sf_dir), keep=["close_time"])
    timed = _drain(spark, streaming.with_latency(closed))
    return timed.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(F.col("latency_ms") < 0).alias("n_negative"),
        F.sum(F.unix_millis("written_at") - F.col("latency_ms")).alias("ready_ms"),
    )


# --- snapshots ---------------------------------------------------------------


@query
def snapshot_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of two coins per event, flattened."""
    coin = F.get_json_object("props", "$.k").cast("int")
    entry = lambda k, price: F.struct(
        F.concat(F.lit("coin-"), k.cast("string")).alias("coin_id"),
        price.alias("current_price"),
        F.col("user_id").cast("double").alias("total_volume"),
    )
    payload = F.to_json(
        F.struct(
            F.col("ts").cast("timestamp").alias("snapshot_time"),
            F.array(entry(coin, F.col("value")), entry(coin + 100, F.col("value") * 2)).alias("coins"),
        ),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return snapshots.flatten_snapshots(b.table(spark, sf_dir, "events").select(payload.alias("payload")))


def _changing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per event: its coin gains a rank if event_id % 3 = 0 and has its price as text if event_id % 5 = 0.

    If event_id % 7 is 1 the payload breaks off, if 2 it lacks its time, if 3 its coins.
    """
    e = b.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    coin = lambda price, *more: F.struct(
        F.concat(F.lit("coin-"), F.get_json_object("props", "$.k")).alias("coin_id"),
        price.alias("current_price"),
        F.col("user_id").cast("double").alias("total_volume"),
        *more,
    )
    rank = (F.col("user_id") % 7 + 1).cast("int").alias("rank")
    n, price = F.col("event_id"), F.col("value")
    time, options = F.col("ts").alias("snapshot_time"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    whole = lambda c: F.to_json(F.struct(time, F.array(c).alias("coins")), options)
    text = (
        F.when(n % 7 == 1, F.concat(F.lit('{"snapshot_time": '), n.cast("string")))
        .when(n % 7 == 2, F.to_json(F.struct(F.array(coin(price)).alias("coins"))))
        .when(n % 7 == 3, F.to_json(F.struct(time), options))
        .when(n % 15 == 0, whole(coin(F.lit("n/a"), rank)))
        .when(n % 5 == 0, whole(coin(F.lit("n/a"))))
        .when(n % 3 == 0, whole(coin(price, rank)))
        .otherwise(whole(coin(price)))
    )
    return e.select(text.alias("payload"))


@query
def snapshot_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coins of payloads whose fields change; a price that is no number stays readable in the kept coin."""
    parsed = snapshots.parse_payloads(_changing_payloads(spark, sf_dir))
    coins = snapshots.flatten_variants(parsed, rank="int")
    return coins.withColumn("price_text", F.try_variant_get("coin", "$.current_price", "string")).select(
        "snapshot_time", "coin_id", "current_price", "total_volume", "rank", (F.col("price_text") == "n/a").alias("price_missing")
    )


@query
def snapshot_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.rejected_payloads(snapshots.parse_payloads(_changing_payloads(spark, sf_dir)))


@query
def daily_coin_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.daily_coin_metrics(b.coin_snapshots(spark, sf_dir), b.trending_snapshots(spark, sf_dir))


@query
def trending_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.trending_frequency(b.trending_snapshots(spark, sf_dir))


@query
def trending_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.trending_totals(b.trending_snapshots(spark, sf_dir))


@query
def market_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.market_overview(staged(b.coin_snapshots(spark, sf_dir), "snapshots"))


@query
def dim_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.first_seen(b.coin_snapshots(spark, sf_dir), b.coin_attributes(spark, sf_dir))


@query
def snapshot_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on the trending facts, of which some lost their coin."""
    facts = b.trending_snapshots(spark, sf_dir)
    lossy = facts.withColumn("coin_id", F.when(F.col("trending_rank") > 1, F.col("coin_id")))
    return snapshots.snapshot_quality(lossy, 5)


@query
def trend_vs_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.trend_versus_cap(b.trending_snapshots(spark, sf_dir), b.coin_snapshots(spark, sf_dir))
