"""Queries over the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators.quality import (
    broken_relationship,
    calendar_gaps,
    expression_false,
    is_null,
    not_accepted,
    not_unique,
    out_of_range,
    quality_rollup,
    recompute_differences,
    silver_report,
    stale_by_test,
    source_freshness,
    stale_symbols,
)
from pricelake.plans.adapters import brand_prices, prices, quality_history, sql, table
from pricelake.plans.gold_queries import Gold
from pricelake.plans.registry import query


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
  HAVING count(*) > 1""",
)
def q_dq_unique(spark, sf_dir):
    return not_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_not_null",
    sql("SELECT symbol, date, open, close FROM prices WHERE open IS NULL", "prices"),
)
def q_dq_not_null(spark, sf_dir):
    return is_null(prices(spark, sf_dir), "open").select("symbol", "date", "open", "close")


@query(
    "dq_bounds",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 450000",
)
def q_dq_bounds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return out_of_range(orders, "o_totalprice", low=5000, high=450_000)


@query(
    "dq_freshness",
    sql(
        """SELECT symbol, max(date) AS max_date FROM brands GROUP BY symbol
  HAVING date_diff('day', max(date), DATE '2001-11-06') > 3""",
        "brands",
    ),
)
def q_dq_freshness(spark, sf_dir):
    return stale_symbols(brand_prices(spark, sf_dir), as_of="2001-11-06", max_lag_days=3)


_TICK_SQL = """ticks AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
    CASE WHEN value > 0.05 THEN value END AS close FROM events)"""


@query(
    "dq_report",
    f"""WITH {_TICK_SQL},
  dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM ticks GROUP BY symbol, date HAVING count(*) > 1)),
  nul AS (SELECT count(*) AS n FROM ticks WHERE close IS NULL),
  oob AS (SELECT count(*) AS n FROM ticks WHERE close < 1.0 OR close > 250.0),
  stale AS (SELECT count(*) AS n
    FROM (SELECT symbol FROM ticks GROUP BY symbol
          HAVING date_diff('day', max(date), DATE '2024-02-20') > 3))
  SELECT 'silver.unique_symbol_date' AS test_name, n = 0 AS passed, n AS row_count,
    'error' AS severity, '{{"duplicate_keys":' || n || '}}' AS details FROM dup
  UNION ALL SELECT 'silver.close_not_null', n = 0, n, 'error',
    '{{"null_close_rows":' || n || '}}' FROM nul
  UNION ALL SELECT 'silver.close_within_bounds', n = 0, n, 'error',
    '{{"out_of_range_rows":' || n || ',"bounds":[1.0,250.0]}}' FROM oob
  UNION ALL SELECT 'silver.freshness', n = 0, n, CASE WHEN n > 0 THEN 'error' ELSE 'info' END,
    '{{"stale_count":' || n || '}}' FROM stale""",
)
def q_dq_report(spark, sf_dir):
    """Raw ticks as prices, three weeks later: every check fails."""
    ticks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.to_date("ts").alias("date"),
        F.when(F.col("value") > 0.05, F.col("value")).alias("close"),
    )
    return silver_report(ticks, as_of="2024-02-20", low=1.0, high=250.0, max_lag_days=3)


@query(
    "dq_relationships",
    """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def q_dq_relationships(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return broken_relationship(docs, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "dq_relationships_orders",
    """SELECT o_orderkey, o_custkey FROM orders
  WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def q_dq_relationships_orders(spark, sf_dir):
    """Orders of customers that are no suppliers: a key with many orphans."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return broken_relationship(orders, "o_custkey", table(spark, sf_dir, "supplier"), "s_suppkey")


@query(
    "dq_accepted_values",
    """SELECT event_id, event_type FROM events
  WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')""",
)
def q_dq_accepted_values(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return not_accepted(events, "event_type", ["click", "view", "purchase", "signup"])


@query(
    "dq_accepted_range",
    """SELECT c_custkey, c_acctbal FROM customer
  WHERE c_mktsegment = 'BUILDING' AND (c_acctbal <= 0 OR c_acctbal >= 9000)""",
)
def q_dq_accepted_range(spark, sf_dir):
    out = out_of_range(
        table(spark, sf_dir, "customer"),
        "c_acctbal",
        low=0,
        high=9000,
        inclusive=False,
        where="c_mktsegment = 'BUILDING'",
    )
    return out.select("c_custkey", "c_acctbal")


@query(
    "dq_unique_combo",
    """SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1""",
)
def q_dq_unique_combo(spark, sf_dir):
    return not_unique(table(spark, sf_dir, "documents"), ["lang", "source"])


@query(
    "dq_expression",
    sql(
        """SELECT symbol, date, open, low, vwap, close FROM prices
  WHERE NOT (low < close AND open <= vwap)""",
        "prices",
    ),
)
def q_dq_expression(spark, sf_dir):
    out = expression_false(prices(spark, sf_dir), "low < close and open <= vwap")
    return out.select("symbol", "date", "open", "low", "vwap", "close")


@query(
    "calendar_gaps",
    sql(
        """SELECT a.asset_id, a.symbol, d.date
  FROM assets a CROSS JOIN dates d
  LEFT JOIN fact f ON f.asset_id = a.asset_id AND f.date_id = d.date_id
  WHERE a.asset_type = 'stock' AND d.is_trading_day AND f.close IS NULL""",
        "assets",
        "dates",
        "fact",
    ),
)
def q_calendar_gaps(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    return calendar_gaps(gold.assets, gold.dates, gold.fact, asset_type="stock")


@query(
    "dq_recompute",
    sql(
        """SELECT a.asset_id, d.date_id,
    round(CASE WHEN day(m.date) = 13 THEN NULL WHEN day(m.date) = 14
      THEN m.rolling_return_30d + 0.001 END, 8) AS rolling_return_30d,
    round(m.rolling_return_30d, 8) AS expected_rolling_return_30d
  FROM metrics m JOIN assets a USING (symbol) JOIN dates d ON d.date = m.date
  WHERE day(m.date) IN (13, 14)""",
        "metrics",
        "assets",
        "dates",
    ),
)
def q_dq_recompute(spark, sf_dir):
    """Stored returns damaged on two days of each month are found, all others agree."""
    from pricelake.plans.adapters import rounded

    gold = Gold(spark, sf_dir)
    day = F.col("date_id") % 100
    value = F.col("rolling_return_30d")
    damaged = gold.metrics().withColumn(
        "rolling_return_30d",
        F.when(day == 13, None).when(day == 14, value + 0.001).otherwise(value),
    )
    out = recompute_differences(damaged, gold.fact, gold.dates, days=30)
    return rounded(out, 8, "rolling_return_30d", "expected_rolling_return_30d")


@query(
    "source_freshness",
    sql(
        """SELECT date_diff('day', max(ingested_at), TIMESTAMP '2001-08-06')::DOUBLE AS age_days,
    CASE WHEN max(ingested_at) < TIMESTAMP '2001-08-01' THEN 'error'
         WHEN max(ingested_at) < TIMESTAMP '2001-08-04' THEN 'warn' ELSE 'pass' END AS status
  FROM prices""",
        "prices",
    ),
)
def q_source_freshness(spark, sf_dir):
    now = F.lit("2001-08-06 00:00:00").cast("timestamp")
    return source_freshness(prices(spark, sf_dir), now=now)


@query(
    "dq_rollup",
    sql(
        """SELECT test_name, count(*) AS runs, count(*) FILTER (WHERE NOT passed) AS failures,
    CAST(coalesce(sum(row_count) FILTER (WHERE event_type = 'click'), 0) AS BIGINT) AS duplicate_keys,
    CAST(coalesce(sum(row_count) FILTER (WHERE event_type = 'view'), 0) AS BIGINT) AS null_close_rows,
    CAST(coalesce(sum(row_count) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT)
      AS out_of_range_rows
  FROM quality q GROUP BY test_name""",
        "quality",
    ),
)
def q_dq_rollup(spark, sf_dir):
    return quality_rollup(quality_history(spark, sf_dir))


@query(
    "dq_stale_symbols",
    sql(
        """SELECT DISTINCT test_name, unnest(['S' || dom, event_type]) AS symbol FROM quality
  WHERE row_count > 0 AND event_type NOT IN ('click', 'view', 'purchase')""",
        "quality",
    ),
)
def q_dq_stale_symbols(spark, sf_dir):
    return stale_by_test(quality_history(spark, sf_dir))
