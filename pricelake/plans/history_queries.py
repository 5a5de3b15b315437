"""Queries over run, quality and timing history."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators.run_history import (
    recent_quality,
    recent_runs,
    run_state,
    stale_runs,
    suggested_range,
    symbol_lag,
)
from pricelake.operators.stage_history import (
    data_window,
    ingest_windows,
    run_groups,
    run_kpis,
    stage_rollup,
    wall_clock,
)
from pricelake.plans.adapters import (
    brand_prices,
    quality_history,
    rounded,
    run_events,
    sql,
    stage_log,
)
from pricelake.plans.registry import query

_STATE_COLS = """run_id, epoch_us(started_at) AS started_us,
    CASE WHEN status <> 'running' THEN epoch_us(last_ts) END AS ended_us, status,
    nullif(rows_by_source, '') AS rows_by_source, nullif(error_payload, '') AS error_payload"""


def _with_micros(runs):
    return runs.select(
        "run_id",
        F.unix_micros("started_at").alias("started_us"),
        F.unix_micros("ended_at").alias("ended_us"),
        "status",
        "rows_by_source",
        "error_payload",
    )


@query("run_state", sql(f"SELECT {_STATE_COLS} FROM runs", "runs"))
def q_run_state(spark, sf_dir):
    return _with_micros(run_state(run_events(spark, sf_dir)))


@query(
    "recent_runs",
    sql(f"SELECT {_STATE_COLS} FROM runs ORDER BY started_at DESC, run_id LIMIT 5", "runs"),
)
def q_recent_runs(spark, sf_dir):
    return _with_micros(recent_runs(run_state(run_events(spark, sf_dir))))


@query(
    "stale_runs",
    sql(
        """SELECT run_id, epoch_us(started_at) AS started_us FROM runs
  WHERE status = 'running' AND started_at < TIMESTAMP '2001-08-01 02:00:00' - INTERVAL 2 HOUR""",
        "runs",
    ),
)
def q_stale_runs(spark, sf_dir):
    now = F.lit("2001-08-01 02:00:00").cast("timestamp")
    out = stale_runs(run_state(run_events(spark, sf_dir)), now=now)
    return out.select("run_id", F.unix_micros("started_at").alias("started_us"))


_LAG_SQL = """SELECT symbol, max(date) AS latest, count(*) AS rows,
    CAST(DATE '2001-11-06' - max(date) AS INTEGER) AS lag_days,
    DATE '2001-11-06' - max(date) > 3 AS stale
  FROM brands GROUP BY symbol"""


@query("symbol_lag", sql(_LAG_SQL, "brands"))
def q_symbol_lag(spark, sf_dir):
    return symbol_lag(brand_prices(spark, sf_dir), today="2001-11-06", max_lag_days=3)


@query(
    "suggested_range",
    sql(
        f"""SELECT min(latest) AS start, DATE '2001-11-05' AS "end" FROM ({_LAG_SQL}) WHERE stale
  HAVING count(*) > 0""",
        "brands",
    ),
)
def q_suggested_range(spark, sf_dir):
    lags = symbol_lag(brand_prices(spark, sf_dir), today="2001-11-06", max_lag_days=3)
    return suggested_range(lags, today="2001-11-06")


@query(
    "dq_recent",
    sql(
        """SELECT run_id, test_name, epoch_us(run_ts) AS run_us, passed, row_count, severity FROM quality
  WHERE run_ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY""",
        "quality",
    ),
)
def q_dq_recent(spark, sf_dir):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    out = recent_quality(quality_history(spark, sf_dir), now=now)
    return out.select(
        "run_id", "test_name", F.unix_micros("run_ts").alias("run_us"), "passed", "row_count", "severity"
    )


@query(
    "stage_rollup",
    sql(
        """SELECT stage, count(*) AS "count", round(sum(duration_s), 4) AS total_s,
    round(avg(duration_s), 4) AS mean_s, max(duration_s) AS max_s,
    CASE WHEN bool_or(status = 'error') THEN 'error' ELSE 'ok' END AS status,
    round(max(rss_mb_peak), 4) AS peak_rss_mb,
    round(sum(rss_mb_end - rss_mb_start), 1) AS delta_rss_mb,
    min(started_at) AS first_started_at,
    CASE any_value(event_type)
      WHEN 'click' THEN '{"silver_rows_merged":' || sum(CAST(k AS BIGINT)) || '}'
      WHEN 'view' THEN '{"duplicate_keys":' || sum(CAST(k AS BIGINT))
        || ',"null_close_rows":0,"out_of_range_rows":' || count(*) || '}'
      ELSE '{"ratio":' || 2 * count(*) || ',"rows":' || sum(CAST(k AS BIGINT)) || '}' END AS meta
  FROM stage GROUP BY stage""",
        "stage",
    ),
)
def q_stage_rollup(spark, sf_dir):
    out = stage_rollup(stage_log(spark, sf_dir))
    return rounded(out, 4, "total_s", "mean_s", "peak_rss_mb")


_END_US = "epoch_us(ts) + CAST(round(duration_s * 1000000) AS BIGINT)"


@query(
    "wall_clock",
    sql(
        f"""SELECT round((max({_END_US}) - min(epoch_us(ts))) / 1000000.0, 6) AS wall_clock_s FROM stage""",
        "stage",
    ),
)
def q_wall_clock(spark, sf_dir):
    return rounded(wall_clock(stage_log(spark, sf_dir)), 6, "wall_clock_s")


_LABELLED = "(SELECT * FROM stage WHERE run_label IS NOT NULL)"


@query(
    "run_groups",
    sql(
        f"""SELECT run_label, min(started_at) AS first_started_at, count(*) AS records,
    CASE WHEN run_label = 'clean_baseline' THEN 'incremental_run'
         ELSE 'Daily run · ' || run_label[7:] END AS display
  FROM {_LABELLED} GROUP BY run_label""",
        "stage",
    ),
)
def q_run_groups(spark, sf_dir):
    return run_groups(stage_log(spark, sf_dir))


_START = "strftime(CAST(ts AS DATE) - CAST(k AS INTEGER), '%Y-%m-%d')"
_END = "strftime(CAST(ts AS DATE) - 50, '%Y-%m-%d')"


@query(
    "ingest_windows",
    sql(
        f"""SELECT run_label, arg_min({_START}, ts) AS start_date, arg_min({_END}, ts) AS end_date
  FROM {_LABELLED} WHERE stage = 'ingest:total' GROUP BY run_label""",
        "stage",
    ),
)
def q_ingest_windows(spark, sf_dir):
    return ingest_windows(stage_log(spark, sf_dir))


@query(
    "data_window",
    sql(
        f"""SELECT min({_START}) AS start_date, max({_END}) AS end_date FROM stage
  WHERE stage = 'ingest:total' AND CAST(k AS INTEGER) >= 50""",
        "stage",
    ),
)
def q_data_window(spark, sf_dir):
    return data_window(stage_log(spark, sf_dir))


@query(
    "run_kpis",
    sql(
        f"""SELECT run_label,
    round((max({_END_US}) - min(epoch_us(ts))) / 1000000.0, 6) AS wall_clock_s,
    CAST(coalesce(sum(CAST(k AS BIGINT)) FILTER (WHERE event_type = 'click'), 0) AS BIGINT)
      AS silver_rows,
    round(CASE WHEN sum(CAST(k AS BIGINT)) FILTER (WHERE event_type = 'click') > 0
        AND sum(duration_s) FILTER (WHERE event_type = 'click') > 0
      THEN sum(CAST(k AS BIGINT)) FILTER (WHERE event_type = 'click')
        / sum(duration_s) FILTER (WHERE event_type = 'click') END, 4) AS rows_per_s,
    count(DISTINCT stage) FILTER (WHERE status = 'error') AS errors,
    arg_min(CAST(k AS BIGINT) + 1, ts) FILTER (WHERE event_type = 'view') AS dq_issues,
    round(max(rss_mb_peak), 4) AS peak_rss_mb
  FROM {_LABELLED} GROUP BY run_label""",
        "stage",
    ),
)
def q_run_kpis(spark, sf_dir):
    out = rounded(run_kpis(stage_log(spark, sf_dir)), 4, "rows_per_s", "peak_rss_mb")
    return rounded(out, 6, "wall_clock_s")
