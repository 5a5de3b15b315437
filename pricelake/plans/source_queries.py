"""Queries over landing, bronze and seeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators.contract import ANALYSIS_RULES, BRONZE_RULES, report
from pricelake.plans.adapters import (
    bar_pages,
    prices,
    rounded,
    sql,
    stage_log,
    table,
    tick_pages,
)
from pricelake.plans.registry import query
from pricelake.sources.bars import normalize_bars, parse_bar_pages
from pricelake.sources.bronze import PARTITIONS, read_bronze
from pricelake.sources.calendar import trading_calendar
from pricelake.sources.combine import union_sources
from pricelake.sources.flat import flat_series
from pricelake.sources.scratch import scratch_folder
from pricelake.sources.seeds import changed_files, fingerprints
from pricelake.sources.series import collapse_to_day, normalize_series, parse_series_pages
from pricelake.sources.stage_log import parse_stage_log

STAMP = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)


def bars(spark, sf_dir):
    return normalize_bars(
        parse_bar_pages(bar_pages(spark, sf_dir)), run_id="landing", ingested_at=STAMP
    )


def ticks(spark, sf_dir):
    """Ticks of all event days but the last."""
    days = table(spark, sf_dir, "events").agg(
        F.min(F.to_date("ts")).alias("a"), F.date_sub(F.max(F.to_date("ts")), 1).alias("b")
    )
    return normalize_series(
        parse_series_pages(tick_pages(spark, sf_dir)),
        start=days.select("a").scalar(),
        end=days.select("b").scalar(),
        run_id="landing",
        ingested_at=STAMP,
    )


def price_bounds(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").agg(F.min(day).alias("start"), F.max(day).alias("end"))


def flat(spark, sf_dir):
    return flat_series(price_bounds(spark, sf_dir), run_id="landing", ingested_at=STAMP)


_BARS_SQL = """SELECT source, asset_type, symbol, date, open, high, low, close, volume,
    CASE WHEN asset_type <> 'fx' THEN vwap END AS vwap, trade_count
  FROM prices WHERE source = 'massive'"""

_TICKS_SQL = """SELECT event_type AS symbol, CAST(event_id AS VARCHAR) AS page_id,
    epoch_us(ts) // 1000 AS ts_ms, CAST(ts AS DATE) AS date, value AS close,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events
  WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)"""

_COLLAPSED_SQL = f"""SELECT symbol, date, arg_min(close, ts_ms) AS close,
    arg_min(volume, ts_ms) AS volume
  FROM ({_TICKS_SQL}) GROUP BY symbol, date"""

_FLAT_SQL = """SELECT 'synthetic' AS source, 'fx' AS asset_type, 'USD' AS symbol,
    CAST(g AS DATE) AS date, 1.0::DOUBLE AS open, 1.0::DOUBLE AS high, 1.0::DOUBLE AS low,
    1.0::DOUBLE AS close
  FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders) b,
       generate_series(b.lo, b.hi, INTERVAL 1 DAY) s(g)"""


@query("normalize_bars", sql(_BARS_SQL, "prices"))
def q_normalize_bars(spark, sf_dir):
    return bars(spark, sf_dir).drop("ingested_at", "run_id")


@query("normalize_series", _TICKS_SQL)
def q_normalize_series(spark, sf_dir):
    return ticks(spark, sf_dir).select("symbol", "page_id", "ts_ms", "date", "close", "volume")


@query("day_collapse", _COLLAPSED_SQL)
def q_day_collapse(spark, sf_dir):
    days = collapse_to_day(ticks(spark, sf_dir), ["ts_ms", "page_id"])
    return days.select("symbol", "date", "close", "volume")


@query("date_spine", _FLAT_SQL)
def q_date_spine(spark, sf_dir):
    return flat(spark, sf_dir).select(
        "source", "asset_type", "symbol", "date", "open", "high", "low", "close"
    )


@query(
    "union_sources",
    sql(
        f"""SELECT source, symbol, date, close FROM (
    SELECT source, symbol, date, close FROM ({_BARS_SQL})
    UNION ALL SELECT 'coingecko', symbol, date, close FROM ({_COLLAPSED_SQL})
    UNION ALL SELECT source, symbol, date, close FROM ({_FLAT_SQL}))
  WHERE symbol <> 'signup'""",
        "prices",
    ),
)
def q_union_sources(spark, sf_dir):
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    catalog = (
        orders.select(F.col("o_orderpriority").alias("symbol"))
        .union(events.where(F.col("event_type") != "signup").select("event_type"))
        .distinct()
        .union(price_bounds(spark, sf_dir).select(F.lit("USD")))
    )
    days = collapse_to_day(ticks(spark, sf_dir), ["ts_ms", "page_id"])
    rows = union_sources(bars(spark, sf_dir), days, flat(spark, sf_dir), catalog=catalog)
    return rows.select("source", "symbol", "date", "close")


@query(
    "bronze_scan",
    sql(
        """SELECT source, asset_type, CAST(ingested_at AS DATE) AS ingested_date, symbol, date, open,
    close, vwap, trade_count
  FROM prices WHERE asset_type <> 'fx'""",
        "prices",
    ),
)
def q_bronze_scan(spark, sf_dir):
    """Bronze files of two writers, read as one table: the close-only ones lack columns or hold whole numbers without a value."""
    root = scratch_folder(spark, "bronze")
    stored = prices(spark, sf_dir).withColumn("ingested_date", F.to_date("ingested_at"))
    close_only = F.col("source") == "coingecko"
    # what an untyped column of nulls is in a file: 32-bit numbers, all null
    bare = stored.where(close_only).withColumns({c: F.lit(None).cast("int") for c in ("open", "vwap", "trade_count")}).drop("high", "low")
    for rows in (bare, stored.where(~close_only)):
        # by day too there would be thousands of folders here
        rows.write.mode("append").partitionBy(*PARTITIONS[:2]).parquet(root)
    return (
        read_bronze(spark, root)
        .where(F.col("asset_type") != "fx")
        .select("source", "asset_type", "ingested_date", "symbol", "date", "open", "close", "vwap", "trade_count")
    )


def _raw_items(spark, sf_dir):
    """Line items dressed as bronze rows that break most of the contract."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "massive")
        .when(F.col("l_returnflag") == "N", "coingecko")
        .otherwise("unknown")
        .alias("source"),
        F.when(F.col("l_linestatus") == "F", "fx").otherwise("bond").alias("asset_type"),
        F.when(F.col("l_linenumber") < 7, F.col("l_partkey").cast("string")).alias("symbol"),
        F.when(F.col("l_quantity") != 1, F.to_date("l_shipdate")).alias("date"),
        (F.col("l_tax") - 0.01).alias("open"),
        (F.col("l_quantity") - 3.0).alias("high"),
        F.col("l_discount").alias("low"),
        F.when(F.col("l_quantity") < 49, F.col("l_extendedprice") - 5000.0).alias("close"),
        F.col("l_quantity").alias("volume"),
        (F.col("l_discount") - 0.02).alias("vwap"),
        (F.col("l_linenumber") - 2).alias("trade_count"),
        F.when(F.col("l_discount") > 0, F.col("l_shipdate").cast("timestamp")).alias("ingested_at"),
        F.when(F.col("l_tax") > 0, F.lit("r")).alias("run_id"),
    )


_RAW_SQL = """raw AS (SELECT
    CASE l_returnflag WHEN 'A' THEN 'massive' WHEN 'N' THEN 'coingecko' ELSE 'unknown' END AS source,
    CASE WHEN l_linestatus = 'F' THEN 'fx' ELSE 'bond' END AS asset_type,
    CASE WHEN l_linenumber < 7 THEN l_partkey END AS symbol,
    CASE WHEN l_quantity <> 1 THEN l_shipdate END AS date,
    l_tax - 0.01 AS open, l_quantity - 3.0 AS high, l_discount AS low,
    CASE WHEN l_quantity < 49 THEN l_extendedprice - 5000.0 END AS close, l_quantity AS volume,
    l_discount - 0.02 AS vwap, l_linenumber - 2 AS trade_count,
    CASE WHEN l_discount > 0 THEN l_shipdate END AS ingested_at,
    CASE WHEN l_tax > 0 THEN 'r' END AS run_id
  FROM lineitem)"""


def _count_sql(check: str, column: str, test: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {test}) AS violations FROM raw"
    )


_BRONZE_CONTRACT_SQL = "WITH " + _RAW_SQL + "\n" + "\nUNION ALL ".join(
    [
        _count_sql("not_null", c, f"{c} IS NULL")
        for c in ("source", "asset_type", "symbol", "date", "close", "ingested_at", "run_id")
    ]
    + [
        _count_sql(
            "accepted_values", "source", "source NOT IN ('massive', 'coingecko', 'synthetic')"
        ),
        _count_sql(
            "accepted_values", "asset_type", "asset_type NOT IN ('stock', 'fx', 'index', 'crypto')"
        ),
    ]
    + [
        _count_sql("at_least_0", c, f"{c} < 0")
        for c in ("open", "high", "low", "close", "volume", "vwap", "trade_count")
    ]
)


@query("contract_bronze", _BRONZE_CONTRACT_SQL)
def q_contract_bronze(spark, sf_dir):
    return report(_raw_items(spark, sf_dir), BRONZE_RULES)


@query(
    "contract_analysis",
    "WITH " + _RAW_SQL + "\n" + "\nUNION ALL ".join(
        [
            _count_sql("not_null", c, f"{c} IS NULL")
            for c in ("symbol", "asset_type", "date", "close")
        ]
        + [_count_sql("at_least_0", "close", "close < 0")]
    ),
)
def q_contract_analysis(spark, sf_dir):
    return report(_raw_items(spark, sf_dir), ANALYSIS_RULES)


@query("trading_calendar", sql("SELECT date, is_trading_day FROM calendar", "calendar"))
def q_trading_calendar(spark, sf_dir):
    return calendar(spark, sf_dir)


def calendar(spark, sf_dir):
    open_days = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "2-HIGH")
        .select(F.to_date("o_orderdate").alias("date"))
    )
    return trading_calendar(price_bounds(spark, sf_dir), open_days)


@query(
    "perf_scan",
    sql(
        """SELECT stage, started_at, duration_s, status, rss_mb_start, round(rss_mb_peak, 6) AS rss_mb_peak,
    rss_mb_end, meta, run_label FROM stage""",
        "stage",
    ),
)
def q_perf_scan(spark, sf_dir):
    """The log as JSON lines (with a nested meta object) read back as records."""
    log = stage_log(spark, sf_dir)
    fields = F.to_json(F.struct(*[c for c in log.columns if c != "meta"]))
    line = F.concat(
        F.substr(fields, F.lit(1), F.length(fields) - 1), F.lit(',"meta":'), F.col("meta"), F.lit("}")
    )
    return rounded(
        parse_stage_log(log.select(line.alias("value"))).drop("pid"), 6, "rss_mb_peak"
    )


@query(
    "changed_files",
    """SELECT d.doc_id AS seed_name
  FROM documents d LEFT JOIN labels l USING (doc_id)
  WHERE l.doc_id IS NULL OR sha256(d.text) <> sha256(CASE WHEN l.toxic = 1 THEN d.text || '.' ELSE d.text END)""",
)
def q_changed_files(spark, sf_dir):
    """Stored fingerprints exist for labelled documents, those of toxic ones are outdated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    stored = fingerprints(
        docs.join(labels, "doc_id").select(
            F.col("doc_id").alias("seed_name"),
            F.when(F.col("toxic") == 1, F.concat("text", F.lit("."))).otherwise(F.col("text")).alias(
                "content"
            ),
        )
    )
    files = docs.select(F.col("doc_id").alias("seed_name"), F.col("text").alias("content"))
    return changed_files(files, stored)
