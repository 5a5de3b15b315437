"""Queries over upsert and ingest windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators.ingest_window import (
    backfill_span,
    ingest_window,
    ingest_window_per_symbol,
    latest_date_per_symbol,
    rows_by_source,
)
from pricelake.operators.upsert import upsert
from pricelake.plans.adapters import order_prices, order_prices_sql, prices, sql, table
from pricelake.plans.registry import query
from pricelake.schemas import BRONZE


@query(
    "silver_upsert",
    f"""WITH old AS ({order_prices_sql("o_orderstatus = 'F'")}),
  arrivals AS (
    SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close,
      o_orderdate + CASE WHEN o_orderstatus = 'P' THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END
        AS ingested_at,
      o_orderkey
    FROM orders WHERE o_orderstatus <> 'F'),
  both_sides AS (
    SELECT symbol, date, close, ingested_at, 0 AS side, -1 AS ord FROM old
    UNION ALL SELECT symbol, date, close, ingested_at, 1, o_orderkey FROM arrivals)
  SELECT symbol, date, close, CAST(ingested_at AS DATE) AS ingested_on,
    CASE WHEN side = 0 THEN 'stored' ELSE 'arrived' END AS run_id
  FROM both_sides
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingested_at DESC, side, ord) = 1""",
)
def q_silver_upsert(spark, sf_dir):
    """Filled orders are stored; open ones arrive as old as those (ignored), pending ones newer."""
    orders = table(spark, sf_dir, "orders")
    stored = order_prices(orders.where(F.col("o_orderstatus") == "F")).withColumn(
        "run_id", F.lit("stored")
    )
    delay = F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
    day = F.to_date("o_orderdate")
    given = {
        "source": F.lit("massive"),
        "asset_type": F.lit("stock"),
        "symbol": F.col("o_orderpriority"),
        "date": day,
        "close": F.col("o_totalprice"),
        "ingested_at": F.date_add(day, delay).cast("timestamp"),
        "run_id": F.lit("arrived"),
    }
    arrived = orders.where(F.col("o_orderstatus") != "F").select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE.fields
        ],
        "o_orderkey",
    )
    merged = upsert(stored, arrived, arrival=["o_orderkey"])
    return merged.select(
        "symbol", "date", "close", F.to_date("ingested_at").alias("ingested_on"), "run_id"
    )


@query("latest_date", sql("SELECT symbol, max(date) AS latest FROM prices GROUP BY symbol", "prices"))
def q_latest_date(spark, sf_dir):
    return latest_date_per_symbol(prices(spark, sf_dir))


@query(
    "ingest_window",
    sql(
        """SELECT 'default' AS kind, max(date) + 1 AS start, DATE '2001-08-14' AS "end",
    max(date) + 1 > DATE '2001-08-14' AS up_to_date FROM prices
  UNION ALL SELECT 'caught up', max(date) + 1, DATE '2001-07-31', max(date) + 1 > DATE '2001-07-31'
    FROM prices
  UNION ALL SELECT 'explicit', DATE '2001-08-10', max(date), false FROM prices""",
        "prices",
    ),
)
def q_ingest_window(spark, sf_dir):
    rows = prices(spark, sf_dir)
    today, back = "2001-08-15", 365
    newest = rows.agg(F.max("date")).scalar()
    cases = {
        "default": ingest_window(rows, today=today, lookback_days=back),
        "caught up": ingest_window(rows, today="2001-08-01", lookback_days=back),
        "explicit": ingest_window(
            rows, today=today, lookback_days=back, start="2001-08-10", end=newest
        ),
    }
    out = None
    for kind, one in cases.items():
        row = one.select(F.lit(kind).alias("kind"), *one.columns)
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "ingest_window_per_symbol",
    """WITH latest AS (SELECT p_brand AS symbol, max(CAST(l_shipdate AS DATE)) AS d
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
  SELECT symbol, coalesce(d + 1, DATE '2001-01-01') AS start, DATE '2001-12-31' AS "end",
    coalesce(d + 1, DATE '2001-01-01') > DATE '2001-12-31' AS up_to_date
  FROM (SELECT DISTINCT p_brand AS symbol FROM part) LEFT JOIN latest USING (symbol)""",
)
def q_ingest_window_per_symbol(spark, sf_dir):
    from pricelake.plans.adapters import brand_prices

    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"))
    return ingest_window_per_symbol(brand_prices(spark, sf_dir), brands, today="2002-01-01", lookback_days=365)


@query(
    "backfill_span",
    sql(
        """SELECT min(date) AS start, DATE '2001-12-31' AS "end", count(DISTINCT symbol) AS symbols,
    count(*) AS rows FROM prices""",
        "prices",
    ),
)
def q_backfill_span(spark, sf_dir):
    return backfill_span(prices(spark, sf_dir), today="2002-01-01")


@query(
    "rows_by_source",
    sql(
        """SELECT '{' || string_agg('"' || source || '":' || n, ',' ORDER BY source) || '}'
    AS rows_by_source FROM (SELECT source, count(*) AS n FROM prices GROUP BY source)""",
        "prices",
    ),
)
def q_rows_by_source(spark, sf_dir):
    return rows_by_source(prices(spark, sf_dir))
