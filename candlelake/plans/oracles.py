"""Independent SQL for the registered queries, for an engine other than Spark.

Each text states the result from the definitions (self joins, plain window
frames, recursive draws) and not from the plans used here.
"""

from __future__ import annotations

from candlelake.plans.registry import (
    BACKFILL_START,
    CONFIG,
    DAY,
    EVENT_LOOKBACK,
    EVENT_MIN_HISTORY,
    EXCLUDED,
    LANDINGS,
    NOW,
    RECENT_DAYS,
    SETTLED,
    SHORT_HISTORY,
    SPLIT,
)
from candlelake.schemas import CANDLE_COLUMNS, DOUBLE_COLUMNS


def select(spec: str, source: str) -> str:
    """``SELECT`` with a type mark per column.

    ``~`` rounds a double, ``@`` shows a date as text, ``#`` is a 64-bit and
    ``%`` a 32-bit integer.
    """
    parts = []
    for item in spec.split():
        name, mark = (item[:-1], item[-1]) if item[-1] in "~@#%" else (item, "")
        shown = {
            "~": f'round(CAST("{name}" AS DOUBLE) * 1e6 + 0.01) / 1e6 + 0.0',
            "@": f'CAST(CAST("{name}" AS DATE) AS VARCHAR)',
            "#": f'CAST("{name}" AS BIGINT)',
            "%": f'CAST("{name}" AS INTEGER)',
            "": f'"{name}"',
        }[mark]
        parts.append(f'{shown} AS "{name}"')
    return "SELECT " + ", ".join(parts) + "\n" + source


CANDLE_SPEC = " ".join(c + "~" if c in DOUBLE_COLUMNS else c for c in CANDLE_COLUMNS)
CANDLE_LIST = ", ".join(f'"{c}"' for c in CANDLE_COLUMNS)
TICK_SPEC = "tick_id symbol timestamp price~"

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts AS "timestamp", event_id AS tick_id, value AS price, user_id,
         CAST(ts AS DATE) AS date
  FROM events)"""


def bars(unit: str, name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT date_trunc('{unit}', ts) AS "timestamp", event_type AS symbol,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume,
         date_trunc('{unit}', ts) + INTERVAL 1 {unit} - INTERVAL 1 MILLISECOND AS close_time,
         sum(value) AS quote_asset_volume, count(*) AS number_of_trades,
         CAST(count(*) FILTER (user_id % 2 = 0) AS DOUBLE) AS taker_buy_base_asset_volume,
         coalesce(sum(value) FILTER (user_id % 2 = 0), 0.0) AS taker_buy_quote_asset_volume
  FROM events GROUP BY 1, 2, 8)"""


DIRTY = f"""copies AS (
  SELECT *, CAST(floor(epoch("timestamp") / 3600) AS BIGINT) % 11 AS d FROM bars),
dirty AS (
  SELECT {CANDLE_LIST} FROM bars
  UNION ALL
  SELECT CASE WHEN d >= 5 THEN "timestamp" + INTERVAL 30 SECOND ELSE "timestamp" END,
         CASE WHEN d = 0 THEN ' ' || symbol || ' ' ELSE symbol END,
         CASE WHEN d = 5 THEN 0.0 ELSE open END,
         CASE WHEN d = 6 THEN low - 1 WHEN d = 7 THEN close - 0.5 ELSE high END,
         CASE WHEN d = 8 THEN open + 0.5 ELSE low END,
         CASE WHEN d = 1 THEN NULL WHEN d = 2 THEN CAST('nan' AS DOUBLE)
              WHEN d = 4 THEN close + 1 ELSE close END,
         CASE WHEN d = 9 THEN -1.0 WHEN d = 10 THEN 0.0 ELSE volume END,
         close_time, quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
         taker_buy_quote_asset_volume
  FROM copies),
complete AS (
  SELECT * REPLACE (trim(symbol) AS symbol) FROM dirty WHERE close IS NOT NULL AND NOT isnan(close))"""

TIE_BREAK = ", ".join(f'"{c}"' for c in CANDLE_COLUMNS if c not in ("timestamp", "symbol"))


def first_rows(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {CANDLE_LIST} FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", symbol ORDER BY {TIE_BREAK}) AS rn FROM {source})
  WHERE rn = 1)"""


STRICT = (
    "open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND high >= open AND "
    "high >= close AND low <= open AND low <= close AND volume >= 0"
)
WEAK = "open > 0 AND high >= low AND volume >= 0"

MINUTE, HOUR = bars("minute"), bars("hour")
CLEAN = f"WITH {MINUTE}, {DIRTY}, {first_rows('complete', 'cleaned')}"

EVENT_CLOSES = """closes AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date, avg(value) AS close FROM events GROUP BY 1, 2)"""
PRIORITY_CLOSES = """closes AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS close
  FROM orders GROUP BY 1, 2)"""
BRAND_CLOSES = """closes AS (
  SELECT upper(p_brand) AS symbol, CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
         100000 + avg(l_extendedprice) AS close
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def universe(filter_fresh: bool = False) -> str:
    fresh = "HAVING max(date) = (SELECT max(date) FROM closes)" if filter_fresh else ""
    return f"""uni AS (
  SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) - 1 AS INTEGER) AS ord
  FROM (SELECT symbol FROM closes GROUP BY symbol {fresh})),
common AS (
  SELECT date FROM closes JOIN uni USING (symbol) GROUP BY date
  HAVING count(*) = (SELECT count(*) FROM uni))"""


def panel_sql(lookback: int, min_history: int, window_days: int | None) -> str:
    """Aligned panel; with ``window_days`` the recent window is tried first."""
    if window_days is None:
        eligible = "SELECT date FROM common"
    else:
        eligible = f"""SELECT date FROM common
    WHERE date >= (SELECT max(date) FROM closes) - {window_days}
       OR (SELECT count(*) FROM common WHERE date >= (SELECT max(date) FROM closes) - {window_days})
          < {min_history + 1}"""
    return f"""kept AS (
  SELECT date FROM (
    SELECT date, row_number() OVER (ORDER BY date DESC) AS rn, count(*) OVER () AS n FROM ({eligible}))
  WHERE rn <= {lookback + 1} AND n >= {min_history + 1}),
panel AS (
  SELECT c.symbol, u.ord, c.date, c.close
  FROM closes c JOIN uni u USING (symbol) JOIN kept USING (date)),
rets AS (
  SELECT symbol, ord, date, close / prev - 1 AS ret FROM (
    SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM panel)
  WHERE prev IS NOT NULL),
stats AS (
  SELECT symbol, ord, avg(ret) AS mean_return, coalesce(stddev_samp(ret), 0) AS stddev_return,
         count(*) AS n_returns
  FROM rets GROUP BY symbol, ord)"""


MATRIX = """covs AS (
  SELECT a.symbol AS symbol_x, b.symbol AS symbol_y, a.ord AS ox, b.ord AS oy,
         covar_samp(a.ret, b.ret) AS covariance
  FROM rets a JOIN rets b USING (date) GROUP BY 1, 2, 3, 4),
matrix AS (
  SELECT c.*, CASE WHEN c.ox = c.oy THEN 1.0
                   WHEN vx.covariance > 0 AND vy.covariance > 0
                   THEN c.covariance / (sqrt(vx.covariance) * sqrt(vy.covariance))
                   ELSE 0.0 END AS correlation
  FROM covs c JOIN covs vx ON vx.ox = c.ox AND vx.oy = c.ox JOIN covs vy ON vy.ox = c.oy AND vy.oy = c.oy)"""

EVENT_RETURNS = (
    f"WITH {EVENT_CLOSES}, {universe()}, {panel_sql(EVENT_LOOKBACK, EVENT_MIN_HISTORY, None)}"
)


def uniform(*parts: str) -> str:
    key = " || '|' || ".join([f"'{CONFIG.seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return (
        f"((CAST(CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))"
        f" / CAST({2**52} AS DOUBLE))"
    )


LIMIT = min(CONFIG.max_active, int(1 / CONFIG.min_weight))
DRAWS = f"""sims AS (
  SELECT CAST(i AS INTEGER) AS sid, (SELECT count(*) FROM uni) AS n FROM range(1, {CONFIG.simulations + 1}) t(i)),
sizes AS (
  SELECT sid, n, least({CONFIG.min_active}, n)
         + CAST(floor({uniform("sid", "'k'")} * (least({LIMIT}, n) - least({CONFIG.min_active}, n) + 1)) AS BIGINT) AS k
  FROM sims),
picks AS (
  SELECT sid, n, k, n - k AS j, CAST([] AS BIGINT[]) AS chosen FROM sizes
  UNION ALL
  SELECT sid, n, k, j + 1, list_append(chosen, CASE WHEN list_contains(chosen, t) THEN j ELSE t END)
  FROM (SELECT *, CAST(floor({uniform("sid", "'a'", "j")} * (j + 1)) AS BIGINT) AS t FROM picks WHERE j < n)),
legs AS (
  SELECT sid, k, i - 1 AS i, chosen[i] AS ord, -ln({uniform("sid", "'w'", "i - 1")}) AS raw
  FROM (SELECT sid, k, chosen, unnest(range(1, k + 1)) AS i FROM picks WHERE j = n)),
cw AS (
  SELECT sid, CAST(ord AS INTEGER) AS ord, CAST({CONFIG.min_weight} AS DOUBLE) + greatest(0, 1 - k * {CONFIG.min_weight})
         * raw / sum(raw) OVER (PARTITION BY sid) AS weight
  FROM legs),
means AS (
  SELECT sid, sum(weight * mean_return) AS mean_return FROM cw JOIN stats USING (ord) GROUP BY sid),
risks AS (
  SELECT a.sid, sqrt(greatest(sum(a.weight * b.weight * m.covariance), 0)) AS vol,
         coalesce(sum(CASE WHEN a.ord < b.ord THEN a.weight * b.weight END), 0) AS pw,
         coalesce(sum(CASE WHEN a.ord < b.ord THEN a.weight * b.weight * abs(m.correlation) END), 0) AS pc
  FROM cw a JOIN cw b USING (sid) JOIN matrix m ON m.ox = a.ord AND m.oy = b.ord GROUP BY a.sid),
holdings AS (SELECT sid, count(*) AS n_active, sum(weight * weight) AS ss FROM cw GROUP BY sid),
scored AS (
  SELECT sid AS simulation_id, pow(1 + mean_return, {CONFIG.periods_per_year}) - 1 AS annualized_return,
         vol * sqrt({CONFIG.periods_per_year}) AS annualized_volatility,
         CASE WHEN n_active <= 1 THEN 0.0 ELSE
           greatest(0, least(1, 0.8 * (1 - CASE WHEN pw > 0 THEN pc / pw ELSE 1 END)
                                + 0.2 * least(1, 1 / ss / n_active))) END AS diversification_score
  FROM means JOIN risks USING (sid) JOIN holdings USING (sid)),
scores AS (
  SELECT *, CASE WHEN annualized_volatility > 0
                 THEN (annualized_return - {CONFIG.risk_free_rate}) / annualized_volatility ELSE 0 END AS sharpe_ratio
  FROM scored),
best AS (SELECT * FROM scores ORDER BY sharpe_ratio DESC, simulation_id LIMIT 1)"""

PORTFOLIOS = f"""sparse AS (
  SELECT 'baseline' AS portfolio_type, 'BRAND#10' AS symbol, CAST(0.5 AS DOUBLE) AS w
  UNION ALL SELECT 'baseline', 'BRAND#2', CAST(0.5 AS DOUBLE)
  UNION ALL SELECT 'benchmark', '{CONFIG.benchmark_symbol}', CAST(1 AS DOUBLE)
  UNION ALL SELECT 'optimized', symbol, weight
  FROM cw JOIN best ON sid = simulation_id JOIN uni USING (ord)),
weights AS (
  SELECT t.portfolio_type, u.symbol, u.ord, coalesce(s.w, CAST(0 AS DOUBLE)) AS weight
  FROM (SELECT DISTINCT portfolio_type FROM (
          SELECT portfolio_type FROM sparse UNION ALL SELECT 'optimized')) t
  CROSS JOIN uni u LEFT JOIN sparse s ON s.portfolio_type = t.portfolio_type AND s.symbol = u.symbol),
series AS (
  SELECT portfolio_type, date, sum(weight * ret) AS ret
  FROM weights JOIN rets USING (symbol) GROUP BY 1, 2),
valued AS (
  SELECT *, {CONFIG.initial_capital} * product(1 + ret) OVER (PARTITION BY portfolio_type ORDER BY date) AS portfolio_value
  FROM series),
paths AS (
  SELECT *, greatest({CONFIG.initial_capital}, max(portfolio_value) OVER (PARTITION BY portfolio_type ORDER BY date)) AS peak
  FROM valued),
all_weights AS (
  SELECT * FROM weights
  UNION ALL SELECT 'equal', symbol, ord, CAST(1 AS DOUBLE) / (SELECT count(*) FROM uni) FROM uni
  UNION ALL SELECT 'empty', symbol, ord, CAST(0 AS DOUBLE) FROM uni),
pair_sums AS (
  SELECT a.portfolio_type, sum(a.weight * b.weight) AS pw, sum(a.weight * b.weight * abs(m.correlation)) AS pc
  FROM all_weights a JOIN all_weights b
    ON a.portfolio_type = b.portfolio_type AND a.ord < b.ord AND a.weight > 1e-6 AND b.weight > 1e-6
  JOIN matrix m ON m.ox = a.ord AND m.oy = b.ord GROUP BY 1),
held AS (
  SELECT portfolio_type, count(*) FILTER (weight > 1e-6) AS n_active, sum(weight * weight) FILTER (weight > 1e-12) AS ss
  FROM all_weights GROUP BY 1),
div_parts AS (
  SELECT portfolio_type, n_active, CASE WHEN pw > 0 THEN pc / pw ELSE 1.0 END AS avg_abs_correlation,
         coalesce(1 / ss, 0.0) AS effective_holdings
  FROM held LEFT JOIN pair_sums USING (portfolio_type)),
div_scores AS (
  SELECT *, CASE WHEN n_active <= 1 THEN 0.0 ELSE
    greatest(0, least(1, 0.8 * (1 - avg_abs_correlation) + 0.2 * least(1, effective_holdings / n_active))) END
    AS diversification_score
  FROM div_parts),
div AS (
  SELECT *, CASE WHEN diversification_score < 0.35 THEN 'Low' WHEN diversification_score < 0.65 THEN 'Medium'
                 ELSE 'High' END AS diversification_label
  FROM div_scores),
summary AS (
  SELECT portfolio_type, max(date) AS as_of_date, avg(ret) AS avg_daily_return,
         coalesce(stddev_samp(ret), 0) AS portfolio_volatility
  FROM series GROUP BY 1),
annual AS (
  SELECT *, pow(1 + avg_daily_return, {CONFIG.periods_per_year}) - 1 AS annualized_return,
         portfolio_volatility * sqrt({CONFIG.periods_per_year}) AS annualized_volatility
  FROM summary),
metrics AS (
  SELECT a.*, p.portfolio_value AS ending_value, p.portfolio_value / {CONFIG.initial_capital} - 1 AS pct_gain,
         CASE WHEN annualized_volatility > 0
              THEN (annualized_return - {CONFIG.risk_free_rate}) / annualized_volatility ELSE 0 END AS sharpe_ratio,
         d.diversification_score, d.diversification_label
  FROM annual a JOIN paths p ON p.portfolio_type = a.portfolio_type AND p.date = a.as_of_date
  JOIN div d ON d.portfolio_type = a.portfolio_type),
backtest AS (
  SELECT p.portfolio_type, p.date, p.portfolio_value, p.portfolio_value / {CONFIG.initial_capital} - 1 AS cumulative_return,
         p.ret AS daily_return, p.portfolio_value / p.peak - 1 AS drawdown,
         CASE WHEN p.portfolio_type <> 'benchmark' THEN q.portfolio_value END AS benchmark_value
  FROM paths p LEFT JOIN paths q ON q.date = p.date AND q.portfolio_type = 'benchmark'),
ranked AS (
  SELECT portfolio_type,
         CASE WHEN portfolio_type = 'optimized' THEN (SELECT simulation_id FROM best) ELSE -1 END AS simulation_id,
         symbol, weight, row_number() OVER (PARTITION BY portfolio_type ORDER BY weight DESC, ord) AS weight_rank,
         CASE WHEN portfolio_type = 'optimized' THEN 'Monte Carlo max-sharpe portfolio'
              ELSE 'User-defined baseline portfolio' END AS notes
  FROM weights WHERE portfolio_type <> 'benchmark' AND weight > 1e-8)"""

SCENARIO = (
    "WITH RECURSIVE "
    + ", ".join(
        [
            BRAND_CLOSES,
            universe(filter_fresh=True),
            panel_sql(CONFIG.lookback, CONFIG.min_history, (CONFIG.lookback + CONFIG.buffer) * CONFIG.period_days),
            MATRIX,
            DRAWS,
            PORTFOLIOS,
        ]
    )
)
METRIC_SPEC = (
    "portfolio_type as_of_date@ sharpe_ratio~ avg_daily_return~ annualized_return~ portfolio_volatility~ "
    "annualized_volatility~ diversification_score~ diversification_label ending_value~ pct_gain~"
)
SCORE_SPEC = "simulation_id annualized_return~ annualized_volatility~ sharpe_ratio~ diversification_score~"

SNAPSHOTS = """facts AS (
  SELECT date_trunc('hour', ts) AS snapshot_time, 'coin-' || json_extract_string(props, '$.k') AS coin_id,
         avg(value) AS current_price, round(sum(value), 2) AS market_cap, CAST(count(*) AS DOUBLE) AS total_volume
  FROM events GROUP BY 1, 2),
snaps AS (
  SELECT f.*, row_number() OVER (PARTITION BY f.snapshot_time ORDER BY f.market_cap DESC, f.coin_id) AS market_cap_rank,
         f.current_price - p.current_price AS price_change_24h
  FROM facts f LEFT JOIN facts p ON p.coin_id = f.coin_id AND p.snapshot_time = f.snapshot_time - INTERVAL 24 HOUR),
trends AS (
  SELECT date_trunc('hour', ts) AS snapshot_time, 'coin-' || json_extract_string(props, '$.k') AS coin_id,
         user_id % 7 + 1 AS trending_rank, event_type AS source
  FROM events)"""

MESSAGES = f"""{MINUTE},
numbered AS (SELECT *, CAST(floor(epoch("timestamp") / 60) AS BIGINT) AS m FROM bars)"""

HALVES = f"""l AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events WHERE ts < TIMESTAMP '{SPLIT}'),
r AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events WHERE ts >= TIMESTAMP '{SPLIT}')"""

FRESH = """last AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, max(CAST(ts AS DATE)) AS last_date FROM events GROUP BY 1),
fresh AS (SELECT * FROM last WHERE last_date = (SELECT max(CAST(ts AS DATE)) FROM events)),
customers AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_custkey AS ord FROM customer)"""

LAST_CLOSES = f"""{TICKS},
closes AS (SELECT symbol, date, arg_max(price, ("timestamp", tick_id)) AS close FROM ticks GROUP BY 1, 2)"""


def gap_sql(unit: str, seconds: int) -> str:
    source = f"""FROM (SELECT *, lag("timestamp") OVER (PARTITION BY symbol ORDER BY "timestamp") AS gap_after,
                              "timestamp" AS gap_before FROM bars) WHERE epoch(gap_before) - epoch(gap_after) > {seconds}"""
    inner = f"SELECT *, (epoch(gap_before) - epoch(gap_after)) / {seconds} - 1 AS n_missing {source}"
    return f"WITH {bars(unit)} " + select("symbol gap_after gap_before n_missing#", f"FROM ({inner})")


DATED = select(CANDLE_SPEC + " date@", 'FROM (SELECT *, CAST("timestamp" AS DATE) AS date FROM bars)')
QUALITY_COLUMNS = "symbol n_rows# low_above_high# zero_volume# not_positive_prices# not_high_is_highest# not_low_is_lowest# not_volume_not_negative# incomplete#"
RETURNS = """rr AS (
  SELECT *, CASE WHEN prev > 0 THEN close / prev - 1 END AS ret FROM (
    SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS prev FROM bars))"""


def oracle_sql() -> dict[str, str]:
    excluded = ", ".join(f"'{s}'" for s in EXCLUDED)
    q: dict[str, str] = {}

    # sources
    q["csv_archive_scan"] = f"WITH {MINUTE} " + select(CANDLE_SPEC, f"FROM bars WHERE symbol NOT IN ({excluded})")
    q["hive_partition_scan"] = f"WITH {MINUTE} " + DATED
    q["single_day_scan"] = f"WITH {MINUTE} " + select(CANDLE_SPEC, f"FROM bars WHERE CAST(\"timestamp\" AS DATE) = DATE '{DAY}'")
    q["daily_layout_scan"] = q["single_day_scan"]
    q["date_cutoff"] = f"WITH {MINUTE} " + select(CANDLE_SPEC, f"FROM bars WHERE CAST(\"timestamp\" AS DATE) >= DATE '{DAY}'")
    q["kline_array_decode"] = f"WITH {MINUTE} " + select(
        CANDLE_SPEC + " ignore n_bad%", "FROM (SELECT *, '0' AS ignore, 0 AS n_bad FROM bars)"
    )
    q["kline_message_decode"] = f"WITH {MINUTE} " + select("symbol timestamp open~ high~ low~ close~ volume~", "FROM bars")
    q["file_row_counts"] = f"WITH {MINUTE} " + select(
        "date@ n_rows# n_symbols# n_files#",
        'FROM (SELECT CAST("timestamp" AS DATE) AS date, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, 1 AS n_files FROM bars GROUP BY 1)',
    )
    q["file_level_total"] = f"WITH {MINUTE} " + select(
        "n_rows# n_files#",
        'FROM (SELECT count(*) AS n_rows, count(DISTINCT CAST("timestamp" AS DATE)) AS n_files FROM bars)',
    )
    q["json_lines_read"] = f"WITH {LAST_CLOSES} " + select("symbol date@ close~", "FROM closes")
    q["sparse_weights"] = f"""WITH {TICKS},
      n AS (SELECT date, symbol, count(*) AS n FROM ticks GROUP BY 1, 2),
      w AS (SELECT CAST(date AS VARCHAR) AS portfolio_type, upper(symbol) AS symbol,
                   round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY date), 4) AS weight FROM n),
      v AS (SELECT portfolio_type, abs(sum(weight) - 1) <= 1e-9 AS ok FROM w GROUP BY 1)
      """ + select("portfolio_type symbol weight~ is_valid%", "FROM (SELECT *, ok AS is_valid FROM w JOIN v USING (portfolio_type))")
    q["dense_weights"] = f"""WITH u AS (
        SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS ord FROM (SELECT DISTINCT upper(event_type) AS symbol FROM events))
      """ + select(
        "portfolio_type symbol ord% weight~",
        "FROM (SELECT *, 'baseline' AS portfolio_type, CASE symbol WHEN 'CLICK' THEN 0.5 WHEN 'VIEW' THEN 0.25 ELSE 0 END AS weight FROM u)",
    )
    q["time_range_select"] = f"WITH {TICKS} " + select(
        TICK_SPEC,
        f"""FROM ticks WHERE "timestamp" >= TIMESTAMP '{BACKFILL_START}'
            AND "timestamp" <= (SELECT max(date) FROM ticks) - INTERVAL 1 MINUTE""",
    )
    q["day_range_select"] = f"WITH {TICKS} " + select(
        TICK_SPEC,
        f"FROM ticks WHERE \"timestamp\" BETWEEN TIMESTAMP '{DAY}' AND TIMESTAMP '{DAY}' + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND",
    )
    q["optional_date_bounds"] = f"WITH {LAST_CLOSES} " + select(
        "symbol date@ close~ bounds",
        f"""FROM (SELECT *, 'start' AS bounds FROM closes WHERE date >= DATE '{DAY}'
            UNION ALL SELECT *, 'end' FROM closes WHERE date <= DATE '{DAY}'
            UNION ALL SELECT *, 'none' FROM closes)""",
    )

    q["footer_bounds"] = f"WITH {MINUTE} " + select(
        "date@ n_rows# min_open_ms# max_open_ms# min_number_of_trades# max_number_of_trades# min_close~ max_close~",
        """FROM (SELECT CAST("timestamp" AS DATE) AS date, count(*) AS n_rows, min(epoch_ms("timestamp")) AS min_open_ms,
              max(epoch_ms("timestamp")) AS max_open_ms, min(number_of_trades) AS min_number_of_trades,
              max(number_of_trades) AS max_number_of_trades, min(close) AS min_close, max(close) AS max_close FROM bars GROUP BY 1)""",
    )
    keys = {"events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}
    q["footer_totals"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, min({key}) AS first_key, max({key}) AS last_key FROM {name}" for name, key in keys.items()
    )
    q["lake_universe_scan"] = f"WITH {MINUTE} " + select(
        CANDLE_SPEC + " date@",
        """FROM (SELECT *, CAST("timestamp" AS DATE) AS date FROM bars
              WHERE symbol IN (SELECT symbol FROM (SELECT symbol, row_number() OVER (ORDER BY symbol) AS n FROM bars GROUP BY symbol) WHERE n > 2))""",
    )

    # sinks
    for name in ("partitioned_overwrite", "partitioned_append", "append_missing_partitions", "serving_load"):
        q[name] = f"WITH {MINUTE} " + DATED
    q["backfill_range"] = f"WITH {MINUTE} " + select(
        "timestamp symbol close~ date@",
        f"""FROM (SELECT "timestamp", symbol, CAST("timestamp" AS DATE) AS date,
              CASE WHEN CAST("timestamp" AS DATE) BETWEEN DATE '{BACKFILL_START}' AND DATE '{DAY}' THEN close ELSE close + 1 END AS close
              FROM bars WHERE CAST("timestamp" AS DATE) <> DATE '{BACKFILL_START}')""",
    )
    q["month_partitions"] = f"WITH {PRIORITY_CLOSES} " + select(
        "month% n_rows# max_close~",
        "FROM (SELECT strftime(date, '%Y%m') AS month, count(*) AS n_rows, max(close) AS max_close FROM closes GROUP BY 1)",
    ).replace('CAST("month" AS INTEGER)', '"month"')
    q["latest_wins"] = f"WITH {TICKS} " + select(
        "symbol timestamp tick_id price~",
        """FROM (SELECT * EXCLUDE ("timestamp"), date_trunc('hour', "timestamp") AS "timestamp",
             row_number() OVER (PARTITION BY symbol, date_trunc('hour', "timestamp") ORDER BY tick_id DESC) AS rn FROM ticks)
           WHERE rn = 1""",
    )
    q["batch_over_stream"] = f"WITH {MINUTE} " + select(
        "timestamp symbol close~ source",
        f"""FROM (SELECT "timestamp", symbol,
              CASE WHEN "timestamp" < TIMESTAMP '{SPLIT}' THEN close ELSE close + 1 END AS close,
              CASE WHEN "timestamp" < TIMESTAMP '{SPLIT}' THEN 'batch' ELSE 'stream' END AS source FROM bars)""",
    )
    q["replace_scenario"] = f"WITH {EVENT_CLOSES} " + select(
        "symbol date@ close~ scenario_id",
        "FROM (SELECT *, 'first' AS scenario_id FROM closes UNION ALL SELECT symbol, date, close * 2, 'second' FROM closes)",
    )
    q["external_table"] = f"WITH {MINUTE} " + select(
        "date@ symbol n_rows# high~",
        'FROM (SELECT CAST("timestamp" AS DATE) AS date, symbol, count(*) AS n_rows, max(high) AS high FROM bars GROUP BY 1, 2)',
    )
    q["evolve_schema"] = f"WITH {EVENT_CLOSES} " + select(
        "symbol date@ close~ simulation_id% abs_distance~",
        f"FROM (SELECT *, CASE WHEN date >= DATE '{DAY}' THEN 7 ELSE -1 END AS simulation_id, abs(100 - close) AS abs_distance FROM closes)",
    )
    q["load_delta"] = f"WITH {MINUTE} " + select(
        "rows_before# rows_after# rows_loaded#",
        f"""FROM (SELECT count(*) FILTER ("timestamp" < TIMESTAMP '{SPLIT}') AS rows_before, count(*) AS rows_after,
                         count(*) FILTER ("timestamp" >= TIMESTAMP '{SPLIT}') AS rows_loaded FROM bars)""",
    )

    # cleaning and quality
    q["clean_candles"] = CLEAN + select(CANDLE_SPEC, "FROM cleaned")
    q["quality_strict"] = CLEAN + select(CANDLE_SPEC, f"FROM cleaned WHERE {STRICT}")
    q["quality_weak"] = CLEAN + select(CANDLE_SPEC, f"FROM cleaned WHERE {WEAK}")
    second = f"SELECT {CANDLE_LIST} FROM bars WHERE \"timestamp\" >= TIMESTAMP '{SPLIT}'"
    q["bulk_etl"] = f"{CLEAN}, united AS (SELECT * FROM cleaned UNION ALL {second}) " + select(
        CANDLE_SPEC + " date@", f'FROM (SELECT *, CAST("timestamp" AS DATE) AS date FROM united WHERE {STRICT})'
    )
    q["cross_source_dedup"] = (
        f"{CLEAN}, united AS (SELECT * FROM cleaned UNION ALL {second}), {first_rows('united', 'single')} "
        + select(CANDLE_SPEC, f"FROM single WHERE {STRICT}")
    )
    q["load_projection"] = f"WITH {MINUTE} " + select(
        CANDLE_SPEC + " date@ origin rising%",
        "FROM (SELECT *, CAST(\"timestamp\" AS DATE) AS date, 'events' AS origin, close > open AS rising FROM bars)",
    )
    q["symbol_filter"] = f"WITH {TICKS} " + select(TICK_SPEC, "FROM ticks WHERE symbol IN ('click', 'view')")
    q["symbol_exclude"] = f"WITH {TICKS} " + select(TICK_SPEC, f"FROM ticks WHERE symbol NOT IN ({excluded})")
    q["preview"] = f"WITH {TICKS} " + select(
        TICK_SPEC, 'FROM (SELECT * FROM ticks ORDER BY "timestamp", tick_id LIMIT 20)'
    )
    q["gaps"] = gap_sql("hour", 3600)
    q["minute_gaps"] = gap_sql("minute", 60)
    q["missing_slots"] = f"WITH {MINUTE}, days AS (SELECT symbol, CAST(\"timestamp\" AS DATE) AS date, count(*) AS n FROM bars GROUP BY 1, 2), " + (
        "span AS (SELECT symbol, CAST(unnest(range(min(date), (SELECT max(date) FROM days) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM days GROUP BY symbol) "
    ) + select(
        "symbol date@ n_present# n_missing#",
        "FROM (SELECT symbol, date, coalesce(n, 0) AS n_present, 1440 - coalesce(n, 0) AS n_missing FROM span LEFT JOIN days USING (symbol, date))",
    )
    q["bitmap_missing_slots"] = q["missing_slots"]
    q["bitmap_gaps"] = q["minute_gaps"]
    q["bitmap_common_dates"] = f"WITH {PRIORITY_CLOSES}, {universe()} " + select("date@", "FROM common")
    q["duplicate_keys"] = f"WITH {MINUTE}, {DIRTY} " + select(
        "symbol timestamp n_rows#",
        'FROM (SELECT trim(symbol) AS symbol, "timestamp", count(*) AS n_rows FROM dirty GROUP BY 1, 2 HAVING count(*) > 1)',
    )
    q["range_violations"] = f"WITH {MINUTE}, {DIRTY} " + select(
        QUALITY_COLUMNS,
        """FROM (SELECT symbol, count(*) AS n_rows, count(*) FILTER (low > high) AS low_above_high,
             count(*) FILTER (volume = 0) AS zero_volume,
             count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS not_positive_prices,
             count(*) FILTER (high < low OR high < open OR high < close) AS not_high_is_highest,
             count(*) FILTER (low > open OR low > close) AS not_low_is_lowest,
             count(*) FILTER (volume < 0) AS not_volume_not_negative,
             count(*) FILTER (close IS NULL OR isnan(close)) AS incomplete
             FROM (SELECT * REPLACE (trim(symbol) AS symbol) FROM dirty) GROUP BY symbol)""",
    )
    q["freshness"] = f"WITH {TICKS} " + select(
        "symbol latest is_stale%",
        f"FROM (SELECT symbol, max(\"timestamp\") AS latest, floor(epoch(TIMESTAMP '{NOW}')) - floor(epoch(max(\"timestamp\"))) > 300 AS is_stale FROM ticks GROUP BY 1)",
    )
    q["ingestion_lag"] = f"WITH {TICKS} " + select(
        "symbol latest lag_seconds#",
        f"FROM (SELECT symbol, max(\"timestamp\") AS latest, floor(epoch(TIMESTAMP '{NOW}')) - floor(epoch(max(\"timestamp\"))) AS lag_seconds FROM ticks GROUP BY 1)",
    )
    q["count_delta"] = CLEAN + select(
        "symbol rows_before# rows_after# rows_dropped#",
        f"""FROM (SELECT symbol, b AS rows_before, a AS rows_after, b - a AS rows_dropped FROM
             (SELECT trim(symbol) AS symbol, count(*) AS b FROM dirty GROUP BY 1)
             LEFT JOIN (SELECT symbol, count(*) AS a FROM cleaned WHERE {STRICT} GROUP BY 1) USING (symbol))""",
    )
    q["guard_report"] = f"WITH {PRIORITY_CLOSES}, {universe()}, {panel_sql(CONFIG.lookback, CONFIG.min_history, None)} " + select(
        "guard violations#",
        f"""FROM (SELECT 'price_not_positive' AS guard, (SELECT count(*) FROM panel WHERE close <= 0 AND date < (SELECT max(date) FROM panel)) AS violations
            UNION ALL SELECT 'symbol_without_history', (SELECT count(*) FROM (SELECT symbol FROM uni UNION ALL SELECT '0-NEW') WHERE symbol NOT IN (SELECT symbol FROM closes))
            UNION ALL SELECT 'benchmark_missing', (SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM uni WHERE symbol = '6-NONE')
            UNION ALL SELECT 'history_too_short', greatest({CONFIG.min_history + 1} - (SELECT count(*) FROM common), 0))""",
    )
    q["feasible_assets"] = select(
        "n_assets% min_active% max_active%",
        f"""FROM (SELECT n AS n_assets, least({CONFIG.min_active}, n) AS min_active,
              least({CONFIG.max_active}, n, floor(1 / {CONFIG.min_weight})) AS max_active
              FROM (SELECT count(DISTINCT p_brand) AS n FROM part))""",
    )

    # daily closes, bars and features
    q["daily_close"] = f"WITH {LAST_CLOSES} " + select("symbol date@ close~", "FROM closes")
    q["series_bounds"] = f"WITH {TICKS} " + select(
        "symbol n_rows# first_ts last_ts last_date@ final_price~",
        """FROM (SELECT symbol, count(*) AS n_rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts,
              max("timestamp") AS last_date, arg_max(price, ("timestamp", tick_id)) AS final_price
              FROM (SELECT * FROM ticks UNION ALL SELECT * REPLACE ('*' AS symbol) FROM ticks) GROUP BY symbol)""",
    )
    q["rollup_hourly"] = f"WITH {HOUR} " + select(CANDLE_SPEC, "FROM bars")
    q["rollup_daily"] = f"WITH {bars('day')} " + select(CANDLE_SPEC, "FROM bars")
    q["top_symbols"] = f"WITH {TICKS} " + select(
        "symbol quote_volume~ trades#",
        "FROM (SELECT symbol, sum(price) AS quote_volume, count(*) AS trades FROM ticks GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)",
    )
    q["bar_returns"] = f"WITH {MINUTE}, {RETURNS} " + select("symbol timestamp close~ ret~", "FROM rr")
    q["moving_averages"] = f"WITH {MINUTE} " + select(
        "symbol timestamp close~ ma_5~ ma_15~",
        """FROM (SELECT symbol, "timestamp", close,
              avg(close) OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5,
              avg(close) OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS ma_15
              FROM bars)""",
    )
    q["rolling_volatility"] = f"WITH {HOUR}, {RETURNS} " + select(
        "symbol timestamp close~ ret~ volatility~",
        """FROM (SELECT symbol, "timestamp", close, ret,
              stddev_samp(ret) OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS volatility
              FROM rr)""",
    )
    frame = 'OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)'
    q["spike_events"] = f"""WITH {HOUR},
      base AS (SELECT *, count(*) {frame} AS n, avg(close) {frame} AS mc, stddev_samp(close) {frame} AS sc,
                      avg(volume) {frame} AS mv, stddev_samp(volume) {frame} AS sv FROM bars),
      z AS (SELECT *, CASE WHEN n = 20 AND sc > 0 THEN (close - mc) / sc ELSE 0 END AS close_z,
                      CASE WHEN n = 20 AND sv > 0 THEN (volume - mv) / sv ELSE 0 END AS volume_z FROM base)
      """ + select(
        "symbol timestamp close~ volume~ close_z~ volume_z~ price_spike% volume_spike%",
        """FROM (SELECT *, abs(close_z) >= 3 AS price_spike, abs(volume_z) >= 3 AS volume_spike FROM z)
           WHERE price_spike OR volume_spike""",
    )

    q["stored_spikes"] = q["spike_events"]

    # symbol sets
    q["ticker_union"] = f"WITH {HALVES} " + select(
        "symbol n_sources#", "FROM (SELECT symbol, count(*) AS n_sources FROM (SELECT * FROM l UNION ALL SELECT * FROM r) GROUP BY 1)"
    )
    q["ticker_intersect"] = f"WITH {HALVES} SELECT l.symbol FROM l JOIN r USING (symbol)"
    q["ticker_except"] = f"""WITH {HALVES} SELECT symbol, 'left' AS side FROM l WHERE symbol NOT IN (SELECT symbol FROM r)
      UNION ALL SELECT symbol, 'right' FROM r WHERE symbol NOT IN (SELECT symbol FROM l)"""
    q["fresh_symbols"] = f"WITH {FRESH} " + select("symbol last_date@", "FROM fresh")
    q["usable_universe"] = f"WITH {FRESH} SELECT symbol, ord FROM customers WHERE symbol IN (SELECT symbol FROM fresh)"
    q["skipped_symbols"] = f"WITH {FRESH} SELECT symbol, ord FROM customers WHERE symbol NOT IN (SELECT symbol FROM fresh)"

    # panel and moments
    priority = f"WITH {PRIORITY_CLOSES}, {universe()}, "
    q["aligned_panel"] = priority + panel_sql(CONFIG.lookback, CONFIG.min_history, None) + select("symbol ord% date@ close~", " FROM panel")
    q["panel_with_fallback"] = (
        priority
        + panel_sql(CONFIG.lookback, CONFIG.min_history, CONFIG.lookback + CONFIG.buffer)
        + select("symbol ord% date@ close~", " FROM panel")
    )
    cases = [
        select(
            "symbol ord% date@ close~ days%",
            f"FROM (WITH {PRIORITY_CLOSES}, {universe()}, {panel_sql(CONFIG.lookback, SHORT_HISTORY, days)} SELECT *, {days} AS days FROM panel)",
        )
        for days in RECENT_DAYS
    ]
    q["panel_fallback_cases"] = " UNION ALL ".join(cases)
    q["asset_returns"] = EVENT_RETURNS + select("symbol ord% date@ ret~", " FROM rets")
    q["return_stats"] = EVENT_RETURNS + select("symbol ord% mean_return~ stddev_return~ n_returns#", " FROM stats")
    q["covariance_matrix"] = f"{EVENT_RETURNS}, {MATRIX} " + select("symbol_x symbol_y covariance~", "FROM matrix")

    q["gram_covariance"] = f"{EVENT_RETURNS}, {MATRIX} " + select("symbol_x symbol_y covariance~ correlation~", "FROM matrix")

    q["two_asset_backtest"] = f"""{EVENT_RETURNS},
      s AS (SELECT date, sum(0.5 * ret) AS r FROM rets WHERE symbol IN ('click', 'view') GROUP BY date),
      v AS (SELECT *, {CONFIG.initial_capital} * product(1 + r) OVER (ORDER BY date) AS portfolio_value FROM s),
      p AS (SELECT *, greatest({CONFIG.initial_capital}, max(portfolio_value) OVER (ORDER BY date)) AS peak FROM v)
      """ + select(
        "portfolio_type date@ portfolio_value~ cumulative_return~ daily_return~ drawdown~",
        f"""FROM (SELECT 'baseline' AS portfolio_type, date, portfolio_value, portfolio_value / {CONFIG.initial_capital} - 1 AS cumulative_return,
              r AS daily_return, portfolio_value / peak - 1 AS drawdown FROM p)""",
    )

    q["value_paths"] = f"""WITH {MINUTE}, {RETURNS},
      v AS (SELECT *, product(1 + coalesce(ret, 0)) OVER w AS portfolio_value FROM rr WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
      p AS (SELECT *, greatest(1.0, max(portfolio_value) OVER (PARTITION BY symbol ORDER BY "timestamp")) AS peak FROM v)
      """ + select(
        "symbol timestamp portfolio_value~ peak~ cumulative_return~ drawdown~",
        "FROM (SELECT *, portfolio_value - 1 AS cumulative_return, portfolio_value / peak - 1 AS drawdown FROM p)",
    )
    q["strict_runs"] = f"""SELECT * FROM (VALUES
      ('sound', NULL), ('benchmark', 'benchmark symbol BRAND#0 is missing or stale'),
      ('history', 'need at least 100001 common dates, got 0'), ('price', 'close is not positive for BRAND#10'),
      ('weights', 'weight string of baseline rejected: 0 bad items, total 1.25')) t(inputs, reason)"""

    # portfolios
    def scenario(spec: str, source: str) -> str:
        return SCENARIO + "\n" + select(spec, source)

    q["correlation_long"] = scenario(
        "as_of_date@ symbol_x symbol_y correlation~ abs_correlation~",
        "FROM (SELECT (SELECT max(date) FROM rets) AS as_of_date, *, abs(correlation) AS abs_correlation FROM matrix)",
    )
    q["candidate_weights"] = scenario(
        "simulation_id ord% symbol weight~", "FROM (SELECT sid AS simulation_id, cw.ord, symbol, weight FROM cw JOIN uni USING (ord))"
    )
    q["candidate_scores"] = scenario(
        SCORE_SPEC + " is_optimal%",
        "FROM (SELECT *, simulation_id = (SELECT simulation_id FROM best) AS is_optimal FROM scores)",
    )
    q["optimal_candidate"] = scenario(SCORE_SPEC, "FROM best")
    q["portfolio_returns"] = scenario("portfolio_type date@ ret~", "FROM series")
    q["portfolio_metrics"] = scenario(METRIC_SPEC, "FROM metrics")
    q["portfolio_backtest"] = scenario(
        "portfolio_type date@ portfolio_value~ cumulative_return~ daily_return~ drawdown~ benchmark_value~", "FROM backtest"
    )
    q["diversification"] = scenario(
        "portfolio_type n_active# avg_abs_correlation~ effective_holdings~ diversification_score~ diversification_label", "FROM div"
    )
    q["ranked_weights"] = scenario("portfolio_type simulation_id% symbol weight~ weight_rank% notes", "FROM ranked")
    c = CONFIG
    q["scenario_row"] = scenario(
        "scenario_id scenario_name investor_name initial_capital~ baseline_label benchmark_symbol optimization_objective "
        "rebalance_frequency risk_free_rate~ training_start_date@ training_end_date@ backtest_start_date@ backtest_end_date@ "
        "asset_universe_size%",
        f"""FROM (SELECT '{c.scenario_id}' AS scenario_id, '{c.scenario_name}' AS scenario_name, '{c.investor_name}' AS investor_name,
             {c.initial_capital} AS initial_capital, '{c.baseline_label}' AS baseline_label, '{c.benchmark_symbol}' AS benchmark_symbol,
             '{c.optimization_objective}' AS optimization_objective, '{c.rebalance_frequency}' AS rebalance_frequency,
             {c.risk_free_rate} AS risk_free_rate, min(date) AS training_start_date, max(date) AS training_end_date,
             (SELECT min(date) FROM rets) AS backtest_start_date, max(date) AS backtest_end_date,
             (SELECT count(*) FROM uni) AS asset_universe_size FROM panel)""",
    )
    q["publish_scenario"] = scenario(
        "table_name n_rows#",
        """FROM (SELECT 'portfolio_scenarios' AS table_name, 1 AS n_rows
            UNION ALL SELECT 'portfolio_weights', count(*) FROM ranked
            UNION ALL SELECT 'portfolio_metrics', count(*) FROM metrics
            UNION ALL SELECT 'portfolio_correlation_matrix', count(*) FROM matrix
            UNION ALL SELECT 'portfolio_backtest_series', count(*) FROM backtest
            UNION ALL SELECT 'portfolio_simulations', count(*) FROM scores)""",
    )
    q["panel_allocation"] = scenario("symbol weight~ weight_rank% simulation_id%", "FROM ranked WHERE portfolio_type = 'optimized'")
    q["panel_kpis"] = scenario(
        "portfolio_type sharpe_ratio~ avg_daily_return~ annualized_volatility~ diversification_label diversification_score~ ending_value~ pct_gain~",
        "FROM metrics",
    )
    q["panel_value_path"] = scenario(
        "date@ baseline~ optimized~ benchmark~",
        """FROM (SELECT date, max(portfolio_value) FILTER (portfolio_type = 'baseline') AS baseline,
              max(portfolio_value) FILTER (portfolio_type = 'optimized') AS optimized,
              max(portfolio_value) FILTER (portfolio_type = 'benchmark') AS benchmark FROM backtest GROUP BY date)""",
    )
    wanted = "(SELECT symbol FROM ranked WHERE portfolio_type = 'optimized' UNION ALL SELECT 'BRAND#10' UNION ALL SELECT 'BRAND#2')"
    q["panel_corr_subset"] = scenario(
        "symbol_x symbol_y correlation~", f"FROM matrix WHERE symbol_x IN {wanted} AND symbol_y IN {wanted}"
    )
    q["panel_search_space"] = scenario(
        "simulation_id annualized_volatility~ annualized_return~ sharpe_ratio~ is_optimal%",
        "FROM (SELECT *, simulation_id = (SELECT simulation_id FROM best) AS is_optimal FROM scores)",
    )

    # streaming
    q["stream_clean"] = f"WITH {MESSAGES} " + select(
        "timestamp symbol open~ high~ low~ close~ volume~ year% month%",
        """FROM (SELECT *, year("timestamp") AS year, month("timestamp") AS month FROM
              (SELECT * FROM numbered UNION ALL SELECT * FROM numbered WHERE m % 3 = 0))""",
    )
    q["stream_dedup"] = f"WITH {MINUTE} " + select("timestamp symbol open~ high~ low~ close~ volume~", "FROM bars")
    q["stream_hourly"] = f"WITH {HOUR} " + select("timestamp symbol open~ high~ low~ close~ volume~", "FROM bars")
    q["stream_restart"] = q["stream_dedup"]
    q["stream_malformed"] = f"WITH {MESSAGES} " + select(
        "n_rows# n_malformed#",
        """FROM (SELECT count(*) + count(*) FILTER (m % 3 = 0) + count(*) FILTER (m % 2 = 0) + count(*) FILTER (m % 5 = 0) AS n_rows,
              count(*) FILTER (m % 5 = 0) AS n_malformed FROM numbered)""",
    )
    q["stream_latency"] = f"WITH {MESSAGES} " + select(
        "symbol n_messages# n_negative# ready_ms#",
        """FROM (SELECT symbol, count(*) AS n_messages, count(*) FILTER (close_time > CAST(now() AS TIMESTAMP)) AS n_negative,
              sum(epoch_ms(close_time)) AS ready_ms
              FROM (SELECT * FROM numbered UNION ALL SELECT * FROM numbered WHERE m % 3 = 0) GROUP BY 1)""",
    )

    q["stream_hourly_restart"] = q["stream_hourly"]
    q["stream_metrics"] = f"WITH {MESSAGES} " + select(
        "n_rows# n_malformed# n_unclosed# n_violations# n_closed# newest lag_seconds#",
        f"""FROM (SELECT count(*) + count(*) FILTER (m % 3 = 0) + count(*) FILTER (m % 2 = 0) + count(*) FILTER (m % 5 = 0) AS n_rows,
              count(*) FILTER (m % 5 = 0) AS n_malformed, count(*) FILTER (m % 2 = 0) AS n_unclosed,
              count(*) FILTER (NOT ({STRICT})) AS n_violations, count(*) + count(*) FILTER (m % 3 = 0) AS n_closed,
              max("timestamp") AS newest, epoch(TIMESTAMP '{NOW}') - epoch(max("timestamp")) AS lag_seconds FROM numbered)""",
    )
    loads = []
    for unit in ("minute", "hour"):
        parts = [bars(unit), DIRTY, first_rows("complete", "cleaned")]
        known = "low IS NOT NULL AND close IS NOT NULL AND NOT isnan(close)"
        loads.append(f"""SELECT * FROM (WITH {", ".join(parts)}
          SELECT '{unit}s' AS run_id, (SELECT count(*) FROM dirty) AS rows_before, (SELECT count(*) FROM cleaned WHERE {STRICT}) AS rows_after,
                 (SELECT count(*) FROM dirty WHERE {known} AND NOT ({STRICT})) AS n_violations,
                 (SELECT count(*) FROM dirty WHERE NOT ({known})) AS n_incomplete)""")
    q["load_metrics"] = select(
        "run_id rows_before# rows_after# rows_dropped# n_violations# n_incomplete#",
        f"FROM (SELECT *, rows_before - rows_after AS rows_dropped FROM ({' UNION ALL '.join(loads)}))",
    )
    # stored: keys no load had settled when they came; the stream stops after half of the span from 2024-01-01 on
    middle = f"TIMESTAMP '2024-01-01' + (TIMESTAMP '{NOW}' - TIMESTAMP '2024-01-01') / {LANDINGS} * {LANDINGS // 2}"
    q["stream_unsettled"] = f"WITH {MINUTE} " + select(
        "symbol timestamp close~",
        f"""FROM bars WHERE "timestamp" >= TIMESTAMP '{SETTLED[1]}'
              OR ("timestamp" >= TIMESTAMP '{SETTLED[0]}' AND "timestamp" < {middle})""",
    )
    q["stream_features"] = f"SELECT *, false AS is_late FROM ({q['moving_averages']})"

    # snapshots
    changing = """changing AS (
      SELECT ts, event_id AS n, 'coin-' || json_extract_string(props, '$.k') AS coin_id, value, user_id FROM events)"""
    q["snapshot_variants"] = f"WITH {changing} " + select(
        "snapshot_time coin_id current_price~ total_volume~ rank% price_missing",
        """FROM (SELECT ts AS snapshot_time, coin_id, CASE WHEN n % 5 <> 0 THEN value END AS current_price, user_id AS total_volume,
                        CASE WHEN n % 3 = 0 THEN user_id % 7 + 1 END AS rank, n % 5 = 0 AS price_missing
                 FROM changing WHERE n % 7 NOT IN (1, 2, 3))""",
    )
    q["snapshot_rejects"] = f"WITH {changing} " + select(
        "reject n_payloads#",
        """FROM (SELECT CASE n % 7 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no snapshot_time' ELSE 'no list of coins' END AS reject, count(*) AS n_payloads
                 FROM changing WHERE n % 7 IN (1, 2, 3) GROUP BY 1)""",
    )
    q["snapshot_flatten"] = select(
        "snapshot_time coin_id current_price~ total_volume~",
        """FROM (SELECT ts AS snapshot_time, 'coin-' || json_extract_string(props, '$.k') AS coin_id, value AS current_price, user_id AS total_volume FROM events
            UNION ALL SELECT ts, 'coin-' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 AS VARCHAR), value * 2, user_id FROM events)""",
    )
    q["daily_coin_metrics"] = f"WITH {SNAPSHOTS} " + select(
        "date@ coin_id avg_price~ max_price~ min_price~ avg_volume~ rank_change% volatility_score~ times_trending#",
        """FROM (SELECT d.*, coalesce(t.n, 0) AS times_trending FROM
             (SELECT CAST(snapshot_time AS DATE) AS date, coin_id, avg(current_price) AS avg_price, max(current_price) AS max_price,
                     min(current_price) AS min_price, avg(total_volume) AS avg_volume,
                     arg_min(market_cap_rank, snapshot_time) - arg_max(market_cap_rank, snapshot_time) AS rank_change,
                     coalesce(stddev_samp(current_price), 0) AS volatility_score FROM snaps GROUP BY 1, 2) d
             LEFT JOIN (SELECT CAST(snapshot_time AS DATE) AS date, coin_id, count(*) AS n FROM trends GROUP BY 1, 2) t
               ON t.date = d.date AND t.coin_id = d.coin_id)""",
    )
    q["trending_frequency"] = f"WITH {SNAPSHOTS} " + select(
        "date@ coin_id times_trending# best_rank%",
        "FROM (SELECT CAST(snapshot_time AS DATE) AS date, coin_id, count(*) AS times_trending, min(trending_rank) AS best_rank FROM trends GROUP BY 1, 2)",
    )
    q["trending_totals"] = f"WITH {SNAPSHOTS} " + select(
        "coin_id times_trending# n_days#",
        "FROM (SELECT coin_id, count(*) AS times_trending, count(DISTINCT CAST(snapshot_time AS DATE)) AS n_days FROM trends GROUP BY 1)",
    )

    def top(section: str, column: str, order: str) -> str:
        return f"""SELECT '{section}' AS section, row_number() OVER (ORDER BY {column} {order}, coin_id) AS position, coin_id,
            CAST({column} AS DOUBLE) AS value FROM latest WHERE {column} IS NOT NULL QUALIFY position <= 5"""

    q["market_overview"] = f"WITH {SNAPSHOTS}, latest AS (SELECT * FROM snaps WHERE snapshot_time = (SELECT max(snapshot_time) FROM snaps)) " + select(
        "section position% coin_id value~",
        f"""FROM (SELECT 'total_market_cap' AS section, 1 AS position, '*' AS coin_id, sum(market_cap) AS value FROM latest
             UNION ALL SELECT 'mean_change_24h', 1, '*', avg(price_change_24h) FROM latest
             UNION ALL ({top('top_gainers', 'price_change_24h', 'DESC')})
             UNION ALL ({top('top_losers', 'price_change_24h', 'ASC')})
             UNION ALL ({top('volume_leaders', 'total_volume', 'DESC')}))""",
    )
    q["dim_first_seen"] = f"WITH {SNAPSHOTS} " + select(
        "coin_id symbol name category platform first_seen_date@",
        """FROM (SELECT f.coin_id, CAST(p_partkey AS VARCHAR) AS symbol, p_name AS name, p_type AS category,
              p_brand AS platform, f.first_seen_date FROM part RIGHT JOIN
              (SELECT coin_id, min(snapshot_time) AS first_seen_date FROM snaps GROUP BY 1) f ON f.coin_id = 'coin-' || p_partkey)""",
    )
    q["snapshot_quality"] = f"""WITH {SNAPSHOTS},
      lossy AS (SELECT snapshot_time, CASE WHEN trending_rank > 1 THEN coin_id END AS coin_id FROM trends)
      """ + select(
        "n_rows# null_keys# duplicate_keys# incomplete_snapshots#",
        """FROM (SELECT (SELECT count(*) FROM lossy) AS n_rows, (SELECT count(*) FROM lossy WHERE coin_id IS NULL) AS null_keys,
             (SELECT count(*) FROM (SELECT 1 FROM lossy WHERE coin_id IS NOT NULL GROUP BY snapshot_time, coin_id HAVING count(*) > 1)) AS duplicate_keys,
             (SELECT count(*) FROM (SELECT 1 FROM lossy GROUP BY snapshot_time HAVING count(DISTINCT coin_id) < 5)) AS incomplete_snapshots)""",
    )
    q["trend_vs_cap"] = f"WITH {SNAPSHOTS} " + select(
        "coin_id snapshot_time trending_rank% source market_cap~ market_cap_rank% rank_gap%",
        """FROM (SELECT t.*, s.market_cap, s.market_cap_rank, s.market_cap_rank - t.trending_rank AS rank_gap
             FROM trends t JOIN snaps s USING (coin_id, snapshot_time))""",
    )
    return q
