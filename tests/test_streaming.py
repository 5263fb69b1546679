"""The candle stream: batch equality, late rows, restart and malformed lines."""

import json

from candlelake import streaming

MINUTE = 60_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC in milliseconds


def line(minute, symbol="BTC", closed=True, close=1.5, **extra):
    t = T0 + minute * MINUTE
    return json.dumps(
        {
            "symbol": symbol, "open": 1.0, "high": 2.0, "low": 0.5, "close": close, "volume": 3.0,
            "open_time": t, "close_time": t + MINUTE - 1, "is_closed": closed, **extra,
        }
    )


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def parsed(spark, folder, **kw):
    return streaming.parse_messages(streaming.message_stream(spark, str(folder), **kw))


def run_dedup(spark, tmp_path):
    stream = streaming.dedup_stream(streaming.closed_candles(parsed(spark, tmp_path / "in")))
    streaming.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), state_partitions=2)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r.symbol, int((r.timestamp.timestamp() * 1000 - T0) / MINUTE)) for r in rows)


def test_dedup_closed_only_and_restart(spark, tmp_path):
    land(tmp_path / "in", "a.txt", line(0), line(0), line(1, closed=False), line(1), line(0, "ETH"), "{broken")
    want = [("BTC", 0), ("BTC", 1), ("ETH", 0)]
    assert run_dedup(spark, tmp_path) == want
    assert run_dedup(spark, tmp_path) == want  # nothing new after a restart
    land(tmp_path / "in", "b.txt", line(1), line(2))  # a repeat within the watermark
    assert run_dedup(spark, tmp_path) == sorted([*want, ("BTC", 2)])


def test_late_row_is_dropped(spark, tmp_path):
    land(tmp_path / "in", "a.txt", line(60))
    run_dedup(spark, tmp_path)
    land(tmp_path / "in", "b.txt", line(10), line(57), line(61))
    # minute 10 is older than the watermark of five minutes, minute 57 is not
    assert run_dedup(spark, tmp_path) == [("BTC", 57), ("BTC", 60), ("BTC", 61)]


def test_malformed_lines_are_counted_once(spark, tmp_path):
    land(tmp_path / "in", "a.txt", line(0), "{broken", '{"symbol": "BTC"}', line(1))
    for _ in range(2):
        streaming.count_malformed(
            parsed(spark, tmp_path / "in"), str(tmp_path / "metrics"), str(tmp_path / "ckpt")
        )
    rows = spark.read.parquet(str(tmp_path / "metrics")).collect()
    assert [(r.n_rows, r.n_malformed) for r in rows] == [(4, 2)]


def test_batch_and_stream_agree(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", f"{i}.txt", *[line(m, s) for m in range(i * 50, i * 50 + 50) for s in ("BTC", "ETH")])
    batch = streaming.closed_candles(
        streaming.parse_messages(spark.read.text(str(tmp_path / "in")))
    )
    stream = streaming.archive_columns(streaming.closed_candles(parsed(spark, tmp_path / "in", files_per_trigger=1)))
    streaming.run_available(
        stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), ("symbol", "year", "month")
    )
    stored = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).select(batch.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))


def test_hourly_summary_waits_for_the_watermark(spark, tmp_path):
    land(tmp_path / "in", "a.txt", *[line(m, close=float(m)) for m in range(0, 130)])
    stream = streaming.hourly_stream(streaming.closed_candles(parsed(spark, tmp_path / "in")))
    streaming.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), state_partitions=2)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp").collect()
    # the newest candle is 02:09, so the watermark is 02:04 and two hours are complete
    assert [(r.close, r.volume) for r in rows] == [(59.0, 180.0), (119.0, 180.0)]


def test_latency(spark, tmp_path):
    land(tmp_path / "in", "a.txt", line(0))
    stream = streaming.with_latency(streaming.closed_candles(parsed(spark, tmp_path / "in"), keep=["close_time"]))
    streaming.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(str(tmp_path / "out")).first().latency_ms > 0
