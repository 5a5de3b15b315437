"""Price, tick, log and trade frames derived from general business tables, and the same
derivations as SQL common table expressions for the comparison statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schemas import BRONZE

BENCHMARK = "1-URGENT"
REFERENCE = "4-NOT SPECIFIED"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; its schema is taken from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round result columns: sums of doubles depend on the order of the rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- prices: orders by priority and day -----------------------------------------------------


def order_prices(orders: DataFrame) -> DataFrame:
    """Silver-shaped prices: symbol = priority, one row per day, OHL unknown for crypto."""
    symbol = F.col("symbol")
    crypto = symbol == BENCHMARK
    day = (
        orders.select(
            F.col("o_orderpriority").alias("symbol"),
            F.to_date("o_orderdate").alias("date"),
            "o_totalprice",
            "o_orderkey",
        )
        .groupBy("symbol", "date")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("_open"),
            F.max("o_totalprice").alias("_high"),
            F.min("o_totalprice").alias("_low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("_n"),
        )
    )

    def known(value: Column) -> Column:
        return F.when(~crypto, value)

    return day.select(
        F.when(crypto, "coingecko").otherwise("massive").alias("source"),
        F.when(crypto, "crypto")
        .when(symbol == REFERENCE, "index")
        .when(symbol == "5-LOW", "fx")
        .otherwise("stock")
        .alias("asset_type"),
        "symbol",
        "date",
        known(F.col("_open")).alias("open"),
        known(F.col("_high")).alias("high"),
        known(F.col("_low")).alias("low"),
        "close",
        F.col("_n").cast("double").alias("volume"),
        known((F.col("_high") + F.col("_low")) / 2.0).alias("vwap"),
        known(F.col("_n")).cast("int").alias("trade_count"),
        F.date_add("date", 1).cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("run-"), F.year("date").cast("string")).alias("run_id"),
    ).select(*BRONZE.fieldNames())


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_prices(table(spark, sf_dir, "orders"))


def order_prices_sql(where: str = "true") -> str:
    return f"""SELECT
    CASE WHEN symbol = '1-URGENT' THEN 'coingecko' ELSE 'massive' END AS source,
    CASE symbol WHEN '1-URGENT' THEN 'crypto' WHEN '4-NOT SPECIFIED' THEN 'index'
                WHEN '5-LOW' THEN 'fx' ELSE 'stock' END AS asset_type,
    symbol, date,
    CASE WHEN symbol <> '1-URGENT' THEN o END AS open,
    CASE WHEN symbol <> '1-URGENT' THEN h END AS high,
    CASE WHEN symbol <> '1-URGENT' THEN l END AS low,
    c AS close, CAST(n AS DOUBLE) AS volume,
    CASE WHEN symbol <> '1-URGENT' THEN (h + l) / 2.0 END AS vwap,
    CASE WHEN symbol <> '1-URGENT' THEN CAST(n AS INTEGER) END AS trade_count,
    CAST(date + 1 AS TIMESTAMP) AS ingested_at,
    'run-' || CAST(year(date) AS VARCHAR) AS run_id
  FROM (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
               arg_min(o_totalprice, o_orderkey) AS o, max(o_totalprice) AS h,
               min(o_totalprice) AS l, arg_max(o_totalprice, o_orderkey) AS c, count(*) AS n
        FROM orders WHERE {where} GROUP BY 1, 2)"""


# -- wider price frames: line items by brand or by part ---------------------------------------


def brand_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = brand; close = highest extended price of the day."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(F.max("l_extendedprice").alias("close"))
        .select("symbol", F.lit("stock").alias("asset_type"), "date", "close")
    )


def type_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = part type; close = highest extended price of the day."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .groupBy(F.col("p_type").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(F.max("l_extendedprice").alias("close"))
    )


def part_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = part; many sparse series that grow with the data."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
            F.to_date("l_shipdate").alias("date"),
        )
        .agg(F.max("l_extendedprice").alias("close"))
        .select("symbol", F.lit("stock").alias("asset_type"), "date", "close")
    )


# -- ticks: events by type ------------------------------------------------------------------


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def tick_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed document per event: the price twice (the later pair counts), a volume, and
    a volume at a moment without a price."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
    k = _k().cast("double")
    payload = F.struct(
        F.array(F.array(ms, F.col("value") + 1.0), F.array(ms, F.col("value"))).alias("prices"),
        F.array(F.array(ms, k), F.array(ms + 1.0, k)).alias("total_volumes"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("page_id"),
        F.col("event_type").alias("symbol"),
        F.lit("crypto").alias("asset_type"),
        F.to_json(payload).alias("payload"),
    )


def bar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed page per symbol and month (at most 31 bars) of the non-crypto prices."""
    day_ms = F.unix_date("date").cast("long") * 86_400_000
    bar = F.struct(
        F.col("open").alias("o"),
        F.col("high").alias("h"),
        F.col("low").alias("l"),
        F.col("close").alias("c"),
        F.col("volume").alias("v"),
        F.when(F.col("asset_type") != "fx", F.col("vwap")).alias("vw"),
        (day_ms + 18_000_000).alias("t"),
        F.col("trade_count").alias("n"),
    )
    page = F.struct(
        F.col("symbol").alias("ticker"),
        F.lit("OK").alias("status"),
        F.size("results").alias("resultsCount"),
        "results",
    )
    return (
        prices(spark, sf_dir)
        .where(F.col("source") == "massive")
        .groupBy("symbol", "asset_type", F.trunc("date", "MM").alias("month"))
        .agg(F.collect_list(bar).alias("results"))
        .select("symbol", "asset_type", F.to_json(page).alias("payload"))
    )


# -- run events, timing log, quality history ----------------------------------------------------


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order opens a run, its line items report an end."""
    opened = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.lit("running").alias("status"),
        F.lit(None).cast("string").alias("rows_by_source"),
        F.lit(None).cast("string").alias("error_payload"),
        F.lit(None).cast("string").alias("git_sha"),
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    ended_us = (
        F.unix_micros(F.col("l_shipdate").cast("timestamp"))
        + F.col("l_linenumber").cast("long") * 3_600_000_000
        + cents
    )
    failed = F.col("l_returnflag") == "R"
    closed = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.timestamp_micros(ended_us).alias("event_ts"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.concat(F.lit('{"massive":'), F.col("l_linenumber").cast("string"), F.lit("}")).alias(
            "rows_by_source"
        ),
        F.when(failed, "returned").alias("error_payload"),
        F.lit(None).cast("string").alias("git_sha"),
    )
    return opened.unionByName(closed)


RUN_EVENTS_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS event_ts,
    'running' AS status, NULL AS rows_by_source, NULL AS error_payload
  FROM orders
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR),
    l_shipdate + to_hours(l_linenumber)
      + to_microseconds(CAST(round(l_extendedprice * 100) AS BIGINT)),
    CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'success' END,
    '{"massive":' || CAST(l_linenumber AS VARCHAR) || '}',
    CASE WHEN l_returnflag = 'R' THEN 'returned' END
  FROM lineitem"""


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timing record per event."""
    e = F.col("event_type")
    day = F.to_date("ts")
    k = _k()
    text = F.concat

    def date_text(shift: Column) -> Column:
        return F.date_format(F.date_add(day, shift), "yyyy-MM-dd")

    ingest_meta = text(
        F.lit('{"silver_rows_merged":'), k, F.lit(',"start_date":"'), date_text(-k.cast("int")),
        F.lit('","end_date":"'), date_text(F.lit(-50)), F.lit('","full":true,"note":"12"}'),
    )
    quality_meta = text(
        F.lit('{"duplicate_keys":'), k, F.lit(',"null_close_rows":0,"out_of_range_rows":1}')
    )
    other_meta = text(F.lit('{"rows":'), k, F.lit(',"ratio":2.75}'))
    memory = F.when(e != "click", F.col("user_id").cast("double"))
    return table(spark, sf_dir, "events").select(
        F.when(e == "click", "ingest:total")
        .when(e == "view", "ingest:dq_assertions")
        .when(e == "purchase", "analyze:returns")
        .when(e == "signup", "transform:run")
        .otherwise("transform:test")
        .alias("stage"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("started_at"),
        F.col("value").alias("duration_s"),
        F.when((e == "error") & (F.col("value") > 100), "error").otherwise("ok").alias("status"),
        F.lit(None).cast("long").alias("pid"),
        memory.alias("rss_mb_start"),
        (memory + F.col("value")).alias("rss_mb_peak"),
        (memory + k.cast("double")).alias("rss_mb_end"),
        F.when(e == "click", ingest_meta)
        .when(e == "view", quality_meta)
        .otherwise(other_meta)
        .alias("meta"),
        F.when(F.dayofmonth("ts") == 2, "clean_baseline")
        .when(F.dayofmonth("ts") > 2, text(F.lit("daily-"), F.date_format("ts", "yyyy-MM-dd")))
        .alias("run_label"),
    )


STAGE_LOG_SQL = """SELECT
    CASE event_type WHEN 'click' THEN 'ingest:total' WHEN 'view' THEN 'ingest:dq_assertions'
      WHEN 'purchase' THEN 'analyze:returns' WHEN 'signup' THEN 'transform:run'
      ELSE 'transform:test' END AS stage,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS started_at,
    value AS duration_s, ts,
    CASE WHEN event_type = 'error' AND value > 100 THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN event_type <> 'click' THEN CAST(user_id AS DOUBLE) END AS rss_mb_start,
    CASE WHEN event_type <> 'click' THEN user_id + value END AS rss_mb_peak,
    CASE WHEN event_type <> 'click' THEN user_id + CAST(k AS DOUBLE) END AS rss_mb_end,
    CASE event_type
      WHEN 'click' THEN '{"silver_rows_merged":' || k || ',"start_date":"'
        || strftime(CAST(ts AS DATE) - CAST(k AS INTEGER), '%Y-%m-%d') || '","end_date":"'
        || strftime(CAST(ts AS DATE) - 50, '%Y-%m-%d') || '","full":true,"note":"12"}'
      WHEN 'view' THEN '{"duplicate_keys":' || k || ',"null_close_rows":0,"out_of_range_rows":1}'
      ELSE '{"rows":' || k || ',"ratio":2.75}' END AS meta,
    CASE WHEN day(ts) = 2 THEN 'clean_baseline'
         WHEN day(ts) > 2 THEN 'daily-' || strftime(ts, '%Y-%m-%d') END AS run_label,
    k, event_type
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)"""


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check result per event type and hour, details as the gate writes them."""
    e = F.col("event_type")
    n = F.col("n").cast("string")
    details = (
        F.when(e == "click", F.concat(F.lit('{"duplicate_keys":'), n, F.lit("}")))
        .when(e == "view", F.concat(F.lit('{"null_close_rows":'), n, F.lit("}")))
        .when(
            e == "purchase",
            F.concat(F.lit('{"out_of_range_rows":'), n, F.lit(',"bounds":[0.0,300.0]}')),
        )
        .otherwise(
            F.concat(
                F.lit('{"stale_symbols":['),
                F.when(
                    F.col("n") > 0,
                    F.concat(F.lit('"S'), F.dayofmonth("hour").cast("string"), F.lit('","'), e, F.lit('"')),
                ).otherwise(""),
                F.lit("]}"),
            )
        )
    )
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.count_if(F.col("value") > 300).alias("n"), F.max("ts").alias("run_ts"))
        .select(
            F.date_format("hour", "yyyyMMddHH").alias("run_id"),
            F.concat(F.lit("silver."), e).alias("test_name"),
            F.col("run_ts").cast("timestamp").alias("run_ts"),
            (F.col("n") == 0).alias("passed"),
            F.col("n").alias("row_count"),
            F.when((e == "signup") & (F.col("n") == 0), "info").otherwise("error").alias("severity"),
            details.alias("details"),
        )
    )


QUALITY_HISTORY_SQL = """SELECT strftime(hour, '%Y%m%d%H') AS run_id,
    'silver.' || event_type AS test_name, run_ts, n = 0 AS passed, n AS row_count,
    CASE WHEN event_type = 'signup' AND n = 0 THEN 'info' ELSE 'error' END AS severity,
    event_type, day(hour) AS dom
  FROM (SELECT event_type, date_trunc('hour', ts) AS hour,
               count(*) FILTER (WHERE value > 300) AS n, max(ts) AS run_ts
        FROM events GROUP BY 1, 2)"""


# -- exchange trades --------------------------------------------------------------------------


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("token_pair"),
        F.col("value").alias("amount_usd"),
        F.col("user_id").alias("taker"),
        F.col("ts").cast("timestamp").alias("block_time"),
    )


def swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw integer amounts: token 0 with 6, token 1 with 18 decimals; purchases pay token 1."""
    micro = F.round(F.col("value") * 1_000_000).cast("decimal(38,0)")
    atto = (F.col("user_id") + 1).cast("decimal(20,0)") * F.lit("1000000000000007").cast("decimal(17,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    pays_one = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("pair"),
        F.when(pays_one, zero).otherwise(micro).alias("amount0In"),
        F.when(pays_one, micro).otherwise(zero).alias("amount0Out"),
        F.when(pays_one, atto.cast("decimal(38,0)")).otherwise(zero).alias("amount1In"),
        F.when(pays_one, zero).otherwise(atto.cast("decimal(38,0)")).alias("amount1Out"),
    )


def token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair, decimals0, decimals1) of the pairs seen."""
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_type").alias("pair"))
        .distinct()
        .withColumns({"decimals0": F.lit(6), "decimals1": F.lit(18)})
    )


# -- common table expressions -----------------------------------------------------------------

_ROLLING = ",\n    ".join(
    f"close / NULLIF(first_value(close) OVER (PARTITION BY symbol ORDER BY date "
    f"RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND CURRENT ROW), 0) - 1.0 AS rolling_return_{n}d"
    for n in (7, 30, 90, 180, 365)
)


def metrics_sql(source: str) -> str:
    """All daily metrics of a (symbol, asset_type, date, close) relation."""
    return f"""SELECT symbol, asset_type, date, close, daily_return, log_return,
    {_ROLLING},
    CASE WHEN count(daily_return) OVER v >= 30 THEN stddev_samp(daily_return) OVER v END
      AS rolling_vol_30d
  FROM (SELECT symbol, asset_type, date, close,
          close / NULLIF(lag(close) OVER w, 0) - 1.0 AS daily_return,
          CASE WHEN close / NULLIF(lag(close) OVER w, 0) > 0
               THEN ln(close / NULLIF(lag(close) OVER w, 0)) END AS log_return
        FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date))
  WINDOW v AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""


def returns_sql(windows: dict[str, int]) -> str:
    """Rows (window, symbol) of returns taken from stored metrics and, for ytd, closes."""
    parts = [
        f"""SELECT '{w}' AS "window", symbol, d - {n} AS start_date, d AS end_date,
      arg_max(rolling_return_{n}d, date) FILTER (WHERE date <= d) AS "return"
    FROM metrics, as_of_day GROUP BY symbol, d"""
        for w, n in windows.items()
    ]
    parts.append(
        """SELECT 'ytd', symbol, CAST(date_trunc('year', d) AS DATE), d,
      arg_max(close, date) FILTER (WHERE date BETWEEN date_trunc('year', d) AND d)
      / arg_min(close, date) FILTER (WHERE date BETWEEN date_trunc('year', d) AND d) - 1.0
    FROM prices, as_of_day GROUP BY symbol, d"""
    )
    union = "\n    UNION ALL ".join(parts)
    return f"""SELECT r.*, b."return" AS btc_return,
    CASE WHEN r.symbol <> '{BENCHMARK}' THEN r."return" > b."return" END AS beats_btc
  FROM ({union}) r
  LEFT JOIN ({union}) b ON b."window" = r."window" AND b.symbol = '{BENCHMARK}'"""


_CTES: dict[str, tuple[list[str], str]] = {
    "prices": ([], order_prices_sql()),
    "as_of_day": (["prices"], "SELECT max(date) AS d FROM prices"),
    "brands": (
        [],
        """SELECT p_brand AS symbol, 'stock' AS asset_type, CAST(l_shipdate AS DATE) AS date,
    max(l_extendedprice) AS close
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    ),
    "by_type": (
        [],
        """SELECT p_type AS symbol, 'stock' AS asset_type, CAST(l_shipdate AS DATE) AS date,
    max(l_extendedprice) AS close
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    ),
    "type_metrics": (["by_type"], metrics_sql("by_type")),
    "parts": (
        [],
        """SELECT 'P' || CAST(l_partkey AS VARCHAR) AS symbol, 'stock' AS asset_type,
    CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close
  FROM lineitem GROUP BY 1, 2, 3""",
    ),
    "metrics": (["prices"], metrics_sql("prices")),
    "brand_metrics": (["brands"], metrics_sql("brands")),
    "part_metrics": (["parts"], metrics_sql("parts")),
    "rbw": (
        ["metrics", "as_of_day"],
        returns_sql({"7d": 7, "1m": 30, "3m": 90, "6m": 180, "1y": 365}),
    ),
    "winners": (
        ["rbw"],
        f"""SELECT list_position(['7d','1m','3m','6m','ytd','1y'], "window") AS position,
    "window", symbol AS winner, "return", btc_return, coalesce(beats_btc, false) AS beats_btc
  FROM rbw WHERE symbol <> '{BENCHMARK}' AND "return" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY "return" DESC, symbol) = 1""",
    ),
    "lump": (
        ["prices", "as_of_day"],
        """SELECT symbol, principal_usd, units, start_date, end_date, start_price, end_price,
    units * end_price AS current_value_usd, units * end_price - principal_usd AS pnl_usd,
    (units * end_price - principal_usd) / principal_usd AS total_return
  FROM (SELECT symbol, 1000.0::DOUBLE AS principal_usd, 1000.0 / arg_min(close, date) FILTER (WHERE date >= s) AS units,
          min(date) FILTER (WHERE date >= s) AS start_date,
          max(date) FILTER (WHERE date <= d) AS end_date,
          arg_min(close, date) FILTER (WHERE date >= s) AS start_price,
          arg_max(close, date) FILTER (WHERE date <= d) AS end_price
        FROM (SELECT p.*, d, CAST(d - INTERVAL 1 YEAR AS DATE) AS s FROM prices p, as_of_day)
        GROUP BY symbol)
  WHERE start_date IS NOT NULL AND end_date IS NOT NULL""",
    ),
    "schedule": (
        ["prices", "as_of_day"],
        """SELECT symbol, i AS buy_no,
    CAST(date_trunc('month', d - 365) + to_months(CAST(i AS INTEGER)) AS DATE) AS target
  FROM (SELECT DISTINCT symbol FROM prices), as_of_day, range(12) t(i)""",
    ),
    "buys": (
        ["schedule"],
        """SELECT s.symbol, s.buy_no, s.target, p.date AS fill_date, p.close AS price,
    100.0 / p.close AS units
  FROM schedule s ASOF JOIN prices p ON p.symbol = s.symbol AND p.date >= s.target""",
    ),
    "dca_totals": (
        ["buys"],
        """SELECT symbol, months, 100.0 * months AS total_invested_usd, total_units,
    final_price_usd, total_units * final_price_usd AS current_value_usd
  FROM (SELECT symbol, count(*) AS months, sum(units) AS total_units FROM buys GROUP BY symbol)
  JOIN (SELECT symbol, arg_max(close, date) FILTER (WHERE date <= d) AS final_price_usd
        FROM prices, as_of_day GROUP BY symbol) USING (symbol)""",
    ),
    "strategies": (
        ["dca_totals", "prices", "as_of_day"],
        """SELECT 'dca' AS strategy, symbol, CAST(total_invested_usd AS DOUBLE) AS principal_usd,
    months AS n_buys, total_units AS units, current_value_usd,
    current_value_usd - total_invested_usd AS pnl_usd,
    (current_value_usd - total_invested_usd) / total_invested_usd AS total_return
  FROM dca_totals
  UNION ALL
  SELECT 'lump_sum', symbol, 1200.0, 1, 1200.0 / a, 1200.0 / a * b, 1200.0 / a * b - 1200.0,
    (1200.0 / a * b - 1200.0) / 1200.0
  FROM (SELECT symbol, arg_min(close, date) FILTER (WHERE date >= d - 365) AS a,
               arg_max(close, date) FILTER (WHERE date <= d) AS b
        FROM prices, as_of_day GROUP BY symbol)
  WHERE a IS NOT NULL AND b IS NOT NULL""",
    ),
    "vol": (
        ["metrics", "as_of_day"],
        """SELECT symbol, asset_type, stddev_samp(daily_return) AS daily_return_stdev,
    count(daily_return) AS n_obs
  FROM metrics, as_of_day
  WHERE date > d - 365 AND date <= d AND daily_return IS NOT NULL
  GROUP BY symbol, asset_type""",
    ),
    "runs": (
        ["run_event"],
        """SELECT run_id, min(event_ts) AS started_at,
    arg_max(status, event_ts) AS status, max(event_ts) AS last_ts,
    arg_max(coalesce(rows_by_source, ''), event_ts) AS rows_by_source,
    arg_max(coalesce(error_payload, ''), event_ts) AS error_payload
  FROM run_event GROUP BY run_id""",
    ),
    "run_event": ([], RUN_EVENTS_SQL),
    "stage": ([], STAGE_LOG_SQL),
    "quality": ([], QUALITY_HISTORY_SQL),
    "types": (
        ["prices"],
        """SELECT row_number() OVER (ORDER BY name) AS asset_type_id, name
  FROM (SELECT DISTINCT asset_type AS name FROM prices)""",
    ),
    "catalog": (
        [],
        """SELECT * FROM (VALUES ('1-URGENT', 'Urgent', 'USD', 'close_volume_only'),
    ('2-HIGH', 'High', 'EUR', 'ohlcv'), ('5-LOW', 'Low', NULL, NULL))
    c(symbol, name, base_ccy, price_completeness)""",
    ),
    "assets": (
        ["prices", "types", "catalog"],
        """SELECT row_number() OVER (ORDER BY a.symbol, a.asset_type, a.source) AS asset_id, a.symbol,
    coalesce(c.name, a.symbol) AS name, t.asset_type_id, a.asset_type, a.source,
    coalesce(c.price_completeness,
      CASE WHEN a.source = 'coingecko' THEN 'close_volume_only' ELSE 'ohlcv' END)
      AS price_completeness,
    coalesce(c.base_ccy, 'USD') AS base_ccy
  FROM (SELECT DISTINCT symbol, asset_type, source FROM prices) a
  JOIN types t ON t.name = a.asset_type LEFT JOIN catalog c ON c.symbol = a.symbol""",
    ),
    "calendar": (
        [],
        """SELECT CAST(g AS DATE) AS date, h.date IS NOT NULL AS is_trading_day
  FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
        FROM orders) b, generate_series(b.lo::TIMESTAMP, b.hi::TIMESTAMP, INTERVAL 1 DAY) s(g)
  LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
             WHERE o_orderpriority = '2-HIGH') h ON h.date = CAST(g AS DATE)""",
    ),
    "dates": (
        ["prices", "calendar"],
        """SELECT CAST(strftime(p.date, '%Y%m%d') AS BIGINT) AS date_id, p.date,
    CAST(year(p.date) AS INTEGER) AS year, CAST(quarter(p.date) AS INTEGER) AS quarter,
    CAST(month(p.date) AS INTEGER) AS month, CAST(day(p.date) AS INTEGER) AS day,
    CAST(dayofweek(p.date) AS INTEGER) AS dow,
    coalesce(c.is_trading_day, dayofweek(p.date) BETWEEN 1 AND 5) AS is_trading_day
  FROM (SELECT DISTINCT date FROM prices) p LEFT JOIN calendar c ON c.date = p.date""",
    ),
    "fact": (
        ["prices", "assets", "dates"],
        """SELECT asset_id, date_id, open, high, low, close, volume, vwap, trade_count, ingested_at
  FROM prices JOIN assets USING (symbol) JOIN dates USING (date)""",
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` preceded by the common table expressions it needs."""
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in _CTES[name][0]:
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS (\n  {_CTES[n][1]}\n)" for n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body
