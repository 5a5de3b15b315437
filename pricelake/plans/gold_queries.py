"""Queries over dimensions, facts and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.returns import daily_return, log_return, rolling_return, series_window
from pricelake.operators.dimensions import dim_asset, dim_asset_type, dim_date
from pricelake.operators.facts import fact_daily_price, star_metrics, star_prices
from pricelake.operators.metrics import (
    add_metrics,
    fact_daily_metrics,
    metric_columns,
    rolling_column,
    rolling_returns,
    with_relative_performance,
)
from pricelake.plans.adapters import (
    BENCHMARK,
    brand_prices,
    order_prices,
    order_prices_sql,
    part_prices,
    prices,
    rounded,
    sql,
    table,
)
from pricelake.plans.registry import query
from pricelake.plans.source_queries import calendar
from pricelake.schemas import ROLLING_DAYS



def catalog(spark) -> DataFrame:
    """Descriptions of some of the symbols."""
    return spark.sql(
        """SELECT * FROM VALUES
        ('1-URGENT', 'Urgent', 'USD', 'close_volume_only'),
        ('2-HIGH', 'High', 'EUR', 'ohlcv'),
        ('5-LOW', 'Low', NULL, NULL)
        AS c(symbol, name, base_ccy, price_completeness)"""
    )


class Gold:
    """The star schema over one silver frame.

    Where silver is a stored table (see ``workflows``) it is read many times; here it is an
    aggregation of the orders, so it is kept (spilling to disk) instead of computed again
    for every dimension. It holds one row per symbol and day.
    """

    def __init__(self, spark, sf_dir):
        self.silver = prices(spark, sf_dir).persist()
        self.catalog = catalog(spark)
        self.types = dim_asset_type(self.silver)
        self.assets = dim_asset(self.silver, self.types, self.catalog).persist()
        self.dates = dim_date(self.silver, calendar(spark, sf_dir)).persist()
        self.fact = fact_daily_price(self.silver, self.assets, self.dates)

    def metrics(self) -> DataFrame:
        fact = self.fact.persist()
        return fact_daily_metrics(fact, self.dates, self.assets, benchmark=BENCHMARK)


@query("dim_asset_type", sql("SELECT asset_type_id, name FROM types", "types"))
def q_dim_asset_type(spark, sf_dir):
    return dim_asset_type(prices(spark, sf_dir))


@query("dim_asset", sql("SELECT * FROM assets", "assets"))
def q_dim_asset(spark, sf_dir):
    return Gold(spark, sf_dir).assets


@query(
    "dim_asset_many",
    sql(
        """SELECT row_number() OVER (ORDER BY symbol) AS asset_id, symbol
  FROM (SELECT DISTINCT symbol FROM parts)""",
        "parts",
    ),
)
def q_dim_asset_many(spark, sf_dir):
    """Numbering of as many assets as there are parts."""
    silver = part_prices(spark, sf_dir).withColumn("source", F.lit("massive"))
    return dim_asset(silver, dim_asset_type(silver), catalog(spark)).select("asset_id", "symbol")


@query(
    "dim_asset_stable",
    sql(
        """SELECT CASE symbol WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '1-URGENT' THEN 3
    WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END::BIGINT AS asset_id, symbol, asset_type FROM assets""",
        "assets",
    ),
)
def q_dim_asset_stable(spark, sf_dir):
    """Stocks got their ids first; the other symbols continue after them."""
    silver = prices(spark, sf_dir)
    stocks = silver.where(F.col("asset_type") == "stock")
    existing = dim_asset(stocks, dim_asset_type(stocks), catalog(spark))
    now = dim_asset(silver, dim_asset_type(silver), catalog(spark), existing)
    return now.select("asset_id", "symbol", "asset_type")


@query("dim_date", sql("SELECT * FROM dates", "dates"))
def q_dim_date(spark, sf_dir):
    return Gold(spark, sf_dir).dates


_FACT_SQL = """SELECT asset_id, date_id, open, high, low, close, volume, vwap, trade_count,
    CAST(ingested_at AS DATE) AS ingested_on"""


def _fact_out(fact: DataFrame) -> DataFrame:
    return fact.withColumn("ingested_on", F.to_date("ingested_at")).drop("ingested_at")


@query("fact_daily_price", sql(f"{_FACT_SQL} FROM fact", "fact"))
def q_fact_daily_price(spark, sf_dir):
    return _fact_out(Gold(spark, sf_dir).fact)


@query(
    "fact_daily_price_incr",
    sql(
        f"""SELECT asset_id, date_id, close, ingested_on FROM (
    SELECT a.asset_id, d.date_id, p.close, p.ingested_on
    FROM (
      SELECT symbol, date, close, CAST(ingested_at AS DATE) + 3650 AS ingested_on, 1 AS pri
      FROM ({order_prices_sql()}) WHERE date >= DATE '1998-01-01' AND ingested_at + INTERVAL 3650 DAY >
        (SELECT max(ingested_at) FROM ({order_prices_sql("o_orderstatus = 'F'")}))
      UNION ALL
      SELECT symbol, date, close, CAST(ingested_at AS DATE), 2
      FROM ({order_prices_sql("o_orderstatus = 'F'")})) p
    JOIN assets a USING (symbol) JOIN dates d USING (date)
    QUALIFY row_number() OVER (PARTITION BY a.asset_id, d.date_id ORDER BY pri) = 1)""",
        "assets",
        "dates",
    ),
)
def q_fact_daily_price_incr(spark, sf_dir):
    """A fact loaded from filled orders takes the silver rows re-ingested since 1998."""
    gold = Gold(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    first = order_prices(orders.where(F.col("o_orderstatus") == "F"))
    current = fact_daily_price(first, gold.assets, gold.dates)
    again = F.col("ingested_at") + F.expr("interval 3650 day")
    later = F.when(F.col("date") >= "1998-01-01", again).otherwise(F.col("ingested_at"))
    silver = gold.silver.withColumn("ingested_at", later)
    incremental = fact_daily_price(silver, gold.assets, gold.dates, current)
    return incremental.select(
        "asset_id", "date_id", "close", F.to_date("ingested_at").alias("ingested_on")
    )


@query(
    "daily_return",
    sql("SELECT symbol, date, round(daily_return, 8) AS daily_return FROM metrics", "metrics"),
)
def q_daily_return(spark, sf_dir):
    p = prices(spark, sf_dir)
    value = daily_return(F.col("close"), series_window(["symbol"]))
    return rounded(p.select("symbol", "date", value.alias("daily_return")), 8, "daily_return")


@query(
    "log_return",
    sql("SELECT symbol, date, round(log_return, 8) AS log_return FROM metrics", "metrics"),
)
def q_log_return(spark, sf_dir):
    p = prices(spark, sf_dir)
    value = log_return(F.col("close"), series_window(["symbol"]))
    return rounded(p.select("symbol", "date", value.alias("log_return")), 8, "log_return")


def _rolling_sql(source: str) -> str:
    cols = ", ".join(f"round(rolling_return_{n}d, 8) AS rolling_return_{n}d" for n in ROLLING_DAYS)
    return f"SELECT symbol, date, {cols} FROM {source}"


_ROLLING_COLS = [rolling_column(n) for n in ROLLING_DAYS]


@query("rolling_return", sql(_rolling_sql("metrics"), "metrics"))
def q_rolling_return(spark, sf_dir):
    """The plain RANGE-frame expression."""
    p = prices(spark, sf_dir)
    out = p.select(
        "symbol",
        "date",
        *[
            rolling_return("close", "date", ["symbol"], n).alias(rolling_column(n))
            for n in ROLLING_DAYS
        ],
    )
    return rounded(out, 8, *_ROLLING_COLS)


@query("rolling_return_parts", sql(_rolling_sql("part_metrics"), "part_metrics"))
def q_rolling_return_parts(spark, sf_dir):
    """The narrow-frame operator on many sparse series with long gaps."""
    p = part_prices(spark, sf_dir).select("symbol", "date", "close")
    out = rolling_returns(p, by=["symbol"], windows=ROLLING_DAYS, slack_days=90)
    return rounded(out.drop("close"), 8, *_ROLLING_COLS)


@query(
    "rolling_vol",
    sql("SELECT symbol, date, round(rolling_vol_30d, 8) AS rolling_vol_30d FROM metrics", "metrics"),
)
def q_rolling_vol(spark, sf_dir):
    from pricelake.operators.metrics import with_daily_returns, with_volatility

    p = prices(spark, sf_dir).select("symbol", "date", "close")
    out = with_volatility(with_daily_returns(p, by=["symbol"]), by=["symbol"])
    return rounded(out.select("symbol", "date", "rolling_vol_30d"), 8, "rolling_vol_30d")


def _relative_sql(source: str, bench: str) -> str:
    return f"""SELECT p.symbol, p.date,
    round(p.close / NULLIF(first_value(p.close) OVER (PARTITION BY p.symbol ORDER BY p.date), 0)
      - b.close / NULLIF((SELECT arg_min(close, date) FROM {source} WHERE symbol = '{bench}'), 0), 8)
      AS rel_perf_vs_btc
  FROM {source} p LEFT JOIN {source} b ON b.symbol = '{bench}' AND b.date = p.date"""


@query("relative_perf", sql(_relative_sql("prices", BENCHMARK), "prices"))
def q_relative_perf(spark, sf_dir):
    p = prices(spark, sf_dir).select("symbol", "date", "close")
    out = with_relative_performance(p, p.where(F.col("symbol") == BENCHMARK), by=["symbol"])
    return rounded(out.drop("close"), 8, "rel_perf_vs_btc")


def _metrics_sql(source: str, metrics: str, bench: str, key: str, joins: str = "") -> str:
    cols = ", ".join(
        f"round(m.{c}, 8) AS {c}" for c in metric_columns() if c != "rel_perf_vs_btc"
    )
    return f"""SELECT {key}, {cols}, r.rel_perf_vs_btc
  FROM {metrics} m
  JOIN ({_relative_sql(source, bench)}) r ON r.symbol = m.symbol AND r.date = m.date {joins}"""


@query(
    "fact_daily_metrics",
    sql(
        _metrics_sql(
            "prices",
            "metrics",
            BENCHMARK,
            "a.asset_id, d.date_id",
            "JOIN assets a ON a.symbol = m.symbol JOIN dates d ON d.date = m.date",
        ),
        "metrics",
        "assets",
        "dates",
    ),
)
def q_fact_daily_metrics(spark, sf_dir):
    return rounded(Gold(spark, sf_dir).metrics(), 8, *metric_columns())


@query(
    "daily_metrics_brands",
    sql(_metrics_sql("brands", "brand_metrics", "Brand#1", "m.symbol, m.date"), "brand_metrics"),
)
def q_daily_metrics_brands(spark, sf_dir):
    """All metrics of the wider frame in one shuffle by symbol."""
    p = brand_prices(spark, sf_dir).select("symbol", "date", "close")
    out = add_metrics(p, p.where(F.col("symbol") == "Brand#1"), by=["symbol"])
    return rounded(out.select("symbol", "date", *metric_columns()), 8, *metric_columns())


@query(
    "daily_metrics_parts",
    sql(_metrics_sql("parts", "part_metrics", "P1", "m.symbol, m.date"), "part_metrics"),
)
def q_daily_metrics_parts(spark, sf_dir):
    """All metrics over as many symbols as there are parts."""
    p = part_prices(spark, sf_dir).select("symbol", "date", "close")
    out = add_metrics(p, p.where(F.col("symbol") == "P1"), by=["symbol"], slack_days=90)
    return rounded(out.select("symbol", "date", *metric_columns()), 8, *metric_columns())


@query(
    "star_prices",
    sql(
        """SELECT a.symbol, t.name AS asset_type, d.date, f.close FROM fact f
  JOIN assets a USING (asset_id) JOIN types t USING (asset_type_id) JOIN dates d USING (date_id)""",
        "fact",
        "assets",
        "types",
        "dates",
    ),
)
def q_star_prices(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return star_prices(g.fact, g.assets, g.types, g.dates)


@query(
    "star_metrics",
    sql(
        _metrics_sql("prices", "metrics", BENCHMARK, "m.symbol, m.asset_type, m.date"),
        "metrics",
    ),
)
def q_star_metrics(spark, sf_dir):
    g = Gold(spark, sf_dir)
    out = star_metrics(g.metrics(), g.assets, g.types, g.dates)
    return rounded(out, 8, *metric_columns())
