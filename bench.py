"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the timed runs per query (after one warm-up; the median is reported);
``BENCH_QUERIES`` may narrow the registered queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from candlelake.operators.candidates import candidate_legs, score_candidates
from candlelake.plans.registry import CONFIG, QUERIES, _scenario
from candlelake.plans.staging import staged
from candlelake.session import build_session, use_utc
from pyspark.sql import functions as F

HEADLINE = [
    "daily_close",
    "rollup_hourly",
    "clean_candles",
    "quality_strict",
    "latest_wins",
    "range_violations",
    "missing_slots",
    "moving_averages",
    "rolling_volatility",
    "spike_events",
    "partitioned_overwrite",
    "panel_with_fallback",
    "correlation_long",
    "two_asset_backtest",
    "candidate_scores",
    "portfolio_metrics",
    "portfolio_backtest",
    "daily_coin_metrics",
    "stream_dedup",
]
CANDIDATES = (10_000, 100_000)


def drain(df) -> None:
    """Compute every row and column without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "candlelake-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)

    wanted = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    jobs = {name: (lambda q=QUERIES[name]: drain(q(spark, sf_dir))) for name in wanted}
    run = _scenario(spark, sf_dir)
    size = run.universe.agg(F.count(F.lit(1))).scalar()
    matrix = staged(run.upper, "matrix")
    for n in CANDIDATES:
        legs = candidate_legs(
            spark, size, n, CONFIG.seed, CONFIG.min_active, CONFIG.max_active, CONFIG.min_weight
        )
        scores = score_candidates(legs, matrix, CONFIG.risk_free_rate, CONFIG.periods_per_year)
        jobs[f"score_{n}_candidates"] = lambda df=scores: drain(df)

    seconds = {}
    for name, job in jobs.items():
        job()
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
