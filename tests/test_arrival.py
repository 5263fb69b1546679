"""What happens when data arrive: open hours in the state, metrics, settled keys, tails, and the readers of footers and folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlelake import sinks, sources, streaming
from candlelake.operators import features, snapshots
from tests.test_streaming import T0, land, line, parsed

START = dt.datetime(2024, 1, 1)


def stream(spark, tmp_path):
    return streaming.dedup_stream(streaming.closed_candles(parsed(spark, tmp_path / "in")))


def run_hours(spark, tmp_path):
    hours = streaming.hourly_stream(stream(spark, tmp_path), late_limit=None)
    streaming.run_available(hours, str(tmp_path / "out"), str(tmp_path / "ckpt"), state_partitions=2)
    shown = lambda df: sorted((r.symbol, r.timestamp.hour, r.open, r.high, r.close, r.volume) for r in df.collect())
    return shown(spark.read.schema(hours.schema).parquet(str(tmp_path / "out"))), shown(streaming.open_hours(spark, str(tmp_path / "ckpt")))


def test_open_hours_come_from_the_state(spark, tmp_path):
    land(tmp_path / "in", "a.txt", line(0, open=1.0, close=1.5), line(59, close=1.7), line(61, close=1.9), line(61, close=1.9), line(3, "ETH"))
    emitted, held = run_hours(spark, tmp_path)
    assert emitted == [] and held == [("BTC", 0, 1.0, 2.0, 1.7, 6.0), ("BTC", 1, 1.0, 2.0, 1.9, 3.0), ("ETH", 0, 1.0, 2.0, 1.5, 3.0)]
    land(tmp_path / "in", "b.txt", line(70, close=1.1))
    emitted, held = run_hours(spark, tmp_path)
    assert [e[:2] for e in emitted] == [("BTC", 0), ("ETH", 0)] and held == [("BTC", 1, 1.0, 2.0, 1.1, 6.0)]
    assert run_hours(spark, tmp_path) == (emitted, held)  # a restart emits no hour twice and loses none


def test_metrics_count_once(spark, tmp_path):
    def run():
        streaming.archive_with_metrics(
            parsed(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "m"), str(tmp_path / "ckpt"), F.lit("2024-01-01 01:00:00").cast("timestamp")
        )
        return sorted(tuple(r)[:6] for r in spark.read.parquet(str(tmp_path / "m")).drop("batch_id", "newest").collect())

    land(tmp_path / "in", "a.txt", line(0), line(0), line(1, closed=False), "{broken", line(2, high=0.1))
    first = [(5, 1, 1, 1, 2, 1)]
    assert run() == first and run() == first
    land(tmp_path / "in", "b.txt", line(30))
    assert run() == [(1, 0, 0, 0, 1, 0), *first]
    lags = {r.lag_seconds for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert lags == {1800, 3480} and spark.read.parquet(str(tmp_path / "out")).count() == 3
    # a batch that comes again replaces its row
    (tmp_path / "ckpt" / "commits" / "1").unlink()
    (tmp_path / "ckpt" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert run() == [(1, 0, 0, 0, 1, 0), *first] and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_settled_keys_do_not_land(spark, tmp_path):
    def settle(*minutes):
        rows = [("BTC", START + dt.timedelta(minutes=m), 9.0) for m in minutes]
        sinks.write_by_date(spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double"), str(tmp_path / "batch"), "append")

    def run():
        streaming.land_unsettled(stream(spark, tmp_path), str(tmp_path / "batch"), str(tmp_path / "out"), str(tmp_path / "ckpt"), state_partitions=2)
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.symbol, int((r.timestamp.timestamp() * 1000 - T0) / 60_000)) for r in rows)

    settle(0, 1)
    land(tmp_path / "in", "a.txt", line(0), line(2), line(0, "ETH"))
    assert run() == [("BTC", 2), ("ETH", 0)]
    settle(3, 1441)  # a load while the stream stands still, with another day
    land(tmp_path / "in", "b.txt", line(1), line(3), line(4), line(1441))
    want = [("BTC", 2), ("BTC", 4), ("ETH", 0)]
    assert run() == want and run() == want


def test_features_as_candles_arrive(spark, tmp_path):
    columns = {"ma_3": lambda w: F.avg("close").over(w.rowsBetween(-2, 0))}

    def run():
        bars = stream(spark, tmp_path).select("timestamp", "symbol", "close")
        streaming.store_features(bars, columns, 2, str(tmp_path / "out"), str(tmp_path / "tails"), str(tmp_path / "ckpt"), state_partitions=2)

    for i, part in enumerate(([0, 1, 2, 3], [4], [1500, 1501, 3000], [3001])):
        land(tmp_path / "in", f"{i}.txt", *(line(m, s, close=float(m % 7 + 1)) for m in part for s in ("BTC", "ETH")))
        run()
        run()
    got = sorted((r.symbol, r.timestamp, r.ma_3) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    rows = [(s, START + dt.timedelta(minutes=m), float(m % 7 + 1)) for m in (0, 1, 2, 3, 4, 1500, 1501, 3000, 3001) for s in ("BTC", "ETH")]
    bars = spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double")
    want = sorted((r.symbol, r.timestamp, r.ma_3) for r in features.moving_averages(bars, (3,)).collect())
    assert got == want
    # a tail is bounded
    newest = spark.read.parquet(str(tmp_path / "tails" / "batch_id=3")) if (tmp_path / "tails" / "batch_id=3").exists() else None
    assert newest is None or newest.count() == 4


def test_late_candles_are_marked(spark, tmp_path):
    columns = {"ma_2": lambda w: F.avg("close").over(w.rowsBetween(-1, 0))}

    def run():
        bars = streaming.closed_candles(parsed(spark, tmp_path / "in")).select("timestamp", "symbol", "close")
        streaming.store_features(bars, columns, 1, str(tmp_path / "out"), str(tmp_path / "tails"), str(tmp_path / "ckpt"))

    land(tmp_path / "in", "a.txt", line(5, close=1.0))
    run()
    land(tmp_path / "in", "b.txt", line(3, close=7.0), line(6, close=2.0))
    run()
    rows = {int((r.timestamp.timestamp() * 1000 - T0) / 60_000): (r.ma_2, r.is_late) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {5: (1.0, False), 3: (None, True), 6: (1.5, False)}


def test_footers_answer_without_reading(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [("2024-01-01", i, float(i)) for i in range(50)] + [("2024-01-02", 100, 7.0), ("2024-01-02", 101, None), ("2024-01-03", 5, None)]
    spark.createDataFrame(rows, "date string, n long, x double").repartition(1).write.partitionBy("date").parquet(path)
    with pytest.raises(Exception, match="No min/max found for Parquet file .*date=2024-01-03"):
        sources.footer_stats(spark, path, ["x"]).collect()
    assert sources.footer_stats(spark, path, ["n"]).collect() == [(53, 0, 101)]
    spark.createDataFrame(rows[:-1], "date string, n long, x double").repartition(1).write.partitionBy("date").parquet(path := f"{path}2")
    stats = sources.footer_stats(spark, path, ["n", "x"], ["date"])
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(n), MAX(n), MIN(x), MAX(x)]" in plan and "PushedGroupBy: [date]" in plan
    got = {str(r.date): tuple(r)[1:] for r in stats.collect()}
    assert got == {"2024-01-01": (50, 0, 49, 0.0, 49.0), "2024-01-02": (2, 100, 101, 7.0, 7.0)}
    assert "PushedAggregation" not in spark.read.parquet(path).groupBy("date").count()._jdf.queryExecution().executedPlan().toString()


def test_universe_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    from candlelake.schemas import CANDLE_COLUMNS

    base = spark.range(6).select(
        *(F.timestamp_seconds(F.lit(1_704_067_200)).alias(c) if c in ("timestamp", "close_time") else F.lit(1.0).alias(c) for c in CANDLE_COLUMNS if c != "symbol"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"),
        F.lit("2024-01-01").alias("date"),
    )
    base.write.partitionBy("symbol", "date").parquet(path)
    spark.createDataFrame([("S1", 1), ("S4", 2), ("S9", 3)], "symbol string, ord int").write.parquet(str(tmp_path / "u"))
    universe = spark.read.parquet(str(tmp_path / "u"))
    df = sources.read_universe(spark, path, universe)
    assert sorted(r.symbol for r in df.collect()) == ["S1", "S4"]
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()
    scan = [n for n in _nodes(df._jdf.queryExecution().executedPlan()) if "numFiles" in _metrics(n) and "staticFilesNum" in _metrics(n)]
    assert scan and _metrics(scan[0])["numFiles"] == 2


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _nodes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _nodes(plan.plan())
    found, children = [plan], plan.children()
    for i in range(children.size()):
        found += _nodes(children.apply(i))
    return found


def _metrics(node):
    found, items = {}, node.metrics().iterator()
    while items.hasNext():
        pair = items.next()
        found[pair._1()] = pair._2().value()
    return found


def test_variants_keep_what_changes(spark):
    texts = [
        '{"snapshot_time": "2024-01-01T00:00:00Z", "coins": [{"coin_id": "a", "current_price": 1.5, "total_volume": 2, "new": {"x": [1]}}, {"coin_id": "b"}]}',
        '{"snapshot_time": "2024-01-01T00:00:00Z", "coins": [{"coin_id": "c", "current_price": "soon"}]}',
        '{"snapshot_time": "2024-01-01T00:00:00Z", "coins": []}',
        "{broken", "", None, "null", "[]", '{"coins": []}', '{"snapshot_time": "never", "coins": []}',
        '{"snapshot_time": "2024-01-01T00:00:00Z", "coins": {"coin_id": "d"}}',
    ]
    parsed_ = snapshots.parse_payloads(spark.createDataFrame([(t,) for t in texts], "payload string"))
    rows = snapshots.flatten_variants(parsed_).withColumn("coin", F.to_json("coin")).orderBy("coin_id").collect()
    assert [(r.coin_id, r.current_price, r.total_volume) for r in rows] == [("a", 1.5, 2.0), ("b", None, None), ("c", None, None)]
    assert '"x":[1]' in rows[0].coin and '"soon"' in rows[2].coin
    rejects = {r.reject: r.n_payloads for r in snapshots.rejected_payloads(parsed_).collect()}
    assert rejects == {snapshots.NOT_JSON: 4, snapshots.NO_TIME: 3, snapshots.NO_COINS: 1}
    assert parsed_.count() == len(texts)


def test_replace_partitions_computes_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(name, n):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return spark.range(n).select(F.lit(name).alias("k"), "id").mapInArrow(count, "k string, id long")

    sinks.replace_partitions(counted("a", 5).union(counted("b", 5)), path, ["k"])
    seen.value = 0
    sinks.replace_partitions(counted("a", 3), path, ["k"], ["k=a", "k=b", "k=c"])
    assert seen.value == 3
    assert {(r.k, r.id) for r in spark.read.parquet(path).collect()} == {("a", 0), ("a", 1), ("a", 2)}


@pytest.mark.parametrize("text, total", [("A:0.5,B:0.75", "1.25"), ("A:x,B:1", "1.0"), (":1", "1.0"), ("A:-1,B:2", "1.0"), ("", "0.0")])
def test_weight_strings_fail_when_read(spark, text, total):
    weights = sources.weights_from_string(spark, "main", text)
    with pytest.raises(Exception, match=rf"weight string of main rejected: \d bad items, total {total}"):
        weights.collect()


def test_a_scenario_is_published_as_one(spark, tmp_path):
    """A run that fails half way leaves the results of the run before in all tables."""
    from candlelake.plans.scenario import publish, read_results
    from candlelake.schemas import RESULT_SCHEMAS, result_columns

    root = str(tmp_path)

    def tables(scenario, n, broken=False):
        out = {}
        for name, schema in RESULT_SCHEMAS.items():
            types = dict(part.split() for part in schema.split(", "))
            values = {"scenario_id": F.lit(scenario), "symbol": F.lit(f"run of {n}")}
            df = spark.range(n).select(*(values.get(c, F.lit(None)).cast(types[c]).alias(c) for c in result_columns(name)))
            out[name] = df.where(F.raise_error(F.lit("lost")).isNull()) if broken and name == "portfolio_metrics" else df
        return out

    def counts():
        return {name: sorted((r.scenario_id, r["count"]) for r in read_results(spark, root, name).groupBy("scenario_id").count().collect()) for name in RESULT_SCHEMAS}

    publish(tables("a", 3), root, "a")
    publish(tables("b", 2), root, "b")
    before = counts()
    assert set(map(tuple, before.values())) == {(("a", 3), ("b", 2))}
    with pytest.raises(Exception, match="lost"):
        publish(tables("a", 7, broken=True), root, "a")
    assert counts() == before
    publish(tables("a", 5), root, "a")
    assert set(map(tuple, counts().values())) == {(("a", 5), ("b", 2))}
    # what was stored by the failed run and by the first one is gone
    kept = [p for p in (tmp_path / "portfolio_weights" / "scenario_id=a").iterdir() if p.is_dir()]
    assert len(kept) == 1
    publish({name: df.limit(0) for name, df in tables("b", 1).items()}, root, "b")
    assert set(map(tuple, counts().values())) == {(("a", 5),)}
