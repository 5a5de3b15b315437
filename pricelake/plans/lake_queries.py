"""Queries over stored, incrementally built tables: what a lake does between two runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions.dates import date_of
from pricelake.operators import metrics_increment
from pricelake.operators.facts import FACT, FACT_MONTH, star_metrics, star_prices
from pricelake.operators.gold_gate import GAPS, KEYS, RECOMPUTED, REFERENCES, ROW_RULES, gold_report
from pricelake.operators.metrics import metric_columns
from pricelake.operators.upsert import merge_into, stage_merge
from pricelake.operators.window_returns import window_return, ytd_return
from pricelake.plans.adapters import BENCHMARK, prices, rounded, sql
from pricelake.plans.gold_queries import Gold, _metrics_sql
from pricelake.plans.registry import query
from pricelake.schemas import BRONZE, FACT_KEY
from pricelake.sources.scratch import scratch_folder
from pricelake.sources.versioned import MonthlyTable, VersionedTable

_YEAR = ("1996-04-01", "1997-03-31")


@query(
    "star_prices_year",
    sql(
        f"""SELECT a.symbol, t.name AS asset_type, d.date, f.close FROM fact f
  JOIN assets a USING (asset_id) JOIN types t USING (asset_type_id) JOIN dates d USING (date_id)
  WHERE d.date BETWEEN DATE '{_YEAR[0]}' AND DATE '{_YEAR[1]}'""",
        "fact", "assets", "types", "dates",
    ),
)
def q_star_prices_year(spark, sf_dir):
    """A year of the stored fact: only its months are listed, and the range reaches the scan."""
    g = Gold(spark, sf_dir)
    fact = MonthlyTable(spark, scratch_folder(spark, "fact"), FACT, FACT_MONTH)
    merge_into(fact, g.fact.select(*FACT.fieldNames()), keys=FACT_KEY)
    return star_prices(fact.between(*_YEAR), g.assets, g.types, g.dates, *_YEAR)


@query(
    "star_metrics_year",
    sql(_metrics_sql("prices", "metrics", BENCHMARK, "m.symbol, m.asset_type, m.date") + f" WHERE m.date BETWEEN DATE '{_YEAR[0]}' AND DATE '{_YEAR[1]}'", "metrics"),
)
def q_star_metrics_year(spark, sf_dir):
    g = Gold(spark, sf_dir)
    metrics = metrics_increment.metrics_table(spark, scratch_folder(spark, "metrics"))
    rows = g.metrics()
    metrics.publish(rows, metrics.touched_months(rows))
    return rounded(star_metrics(metrics.between(*_YEAR), g.assets, g.types, g.dates, *_YEAR), 8, *metric_columns())


@query(
    "returns_recent",
    sql(
        """SELECT s.symbol, round(y.last / y.first - 1, 8) AS ytd, round(w.last / w.first - 1, 8) AS last_40d
  FROM (SELECT DISTINCT symbol FROM prices) s
  LEFT JOIN (SELECT symbol, arg_max(close, date) AS last, arg_min(close, date) AS first FROM prices
             WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-05-20' GROUP BY symbol) y USING (symbol)
  LEFT JOIN (SELECT symbol, arg_max(close, date) AS last, arg_min(close, date) AS first FROM prices
             WHERE date BETWEEN DATE '1998-04-10' AND DATE '1998-05-20' GROUP BY symbol) w USING (symbol)""",
        "prices",
    ),
)
def q_returns_recent(spark, sf_dir):
    """Year to date and the last forty days: symbols from the dimension, prices of the windows only."""
    g = Gold(spark, sf_dir)
    p = g.silver.select("symbol", "date", "close")
    ytd = ytd_return(p, "1998-05-20", g.assets).withColumnRenamed("return", "ytd")
    last = window_return(p, 40, "1998-05-20", g.assets).withColumnRenamed("return", "last_40d")
    return rounded(ytd.join(last, "symbol"), 8, "ytd", "last_40d")


@query(
    "metrics_incremental",
    sql(
        _metrics_sql(
            "prices", "metrics", BENCHMARK, "a.asset_id, d.date_id",
            "JOIN assets a ON a.symbol = m.symbol JOIN dates d ON d.date = m.date",
        ),
        "metrics", "assets", "dates",
    ),
)
def q_metrics_incremental(spark, sf_dir):
    """Metrics of a fact that came in three batches: history with wrong closes on some days, a later span, corrections."""
    g = Gold(spark, sf_dir)
    root = scratch_folder(spark, "increments")
    fact = MonthlyTable(spark, f"{root}/fact", FACT, FACT_MONTH)
    index, metrics = metrics_increment.index_table(spark, f"{root}/index"), metrics_increment.metrics_table(spark, f"{root}/metrics")
    own = g.assets.where(F.col("symbol") == BENCHMARK).agg(F.min("asset_id")).first()[0]
    rows = g.fact.select(*FACT.fieldNames())
    day = F.col("date_id")
    # closes of a month are wrong at first, except for the benchmark
    late = (day >= 19970601) & (day < 19970701) & (F.col("asset_id") != own)
    batches = [
        rows.where(day < 19980101).withColumn("close", F.when(late, F.col("close") * 2).otherwise(F.col("close"))),
        rows.where(day >= 19980101),
        rows.where(late),
    ]
    for batch in batches:
        staged = stage_merge(fact, batch, fact.touched_months(batch), keys=FACT_KEY, always_replace=True)
        months = index.stage(metrics_increment.month_index(staged.rows()), staged.months)
        spans = VersionedTable(spark, f"{root}/spans")
        done = metrics_increment.stage_metrics(metrics, staged, months, batch, benchmark_id=own, spans_table=spans)
        for part in (staged, months, done.staged):
            part.commit()
    return rounded(metrics.read(), 8, *metric_columns())


@query(
    "silver_widened",
    sql(
        """SELECT symbol, date, close, CASE WHEN date >= DATE '1998-01-01' THEN asset_type || '-1' END AS venue FROM prices""",
        "prices",
    ),
)
def q_silver_widened(spark, sf_dir):
    """A stored table that gains a column with its second batch: months written before hold nulls there."""
    table = MonthlyTable(spark, scratch_folder(spark, "widened"), BRONZE)
    rows = prices(spark, sf_dir).select(*BRONZE.fieldNames())
    merge_into(table, rows.where("date < '1998-01-01'"))
    merge_into(table, rows.where("date >= '1998-01-01'").withColumn("venue", F.concat("asset_type", F.lit("-1"))))
    return table.read().select("symbol", "date", "close", "venue")


def _gate_sql() -> str:
    source = {"dim_asset_type": "types_", "dim_asset": "assets_", "dim_date": "dates", "fact_daily_price": "fact_", "fact_daily_metrics": "metrics_"}
    counts = [
        f"SELECT '{t}.{name}' AS test_name, count(*) FILTER (WHERE {bad}) AS row_count FROM {source[t]}"
        for t, rules in ROW_RULES.items() for name, bad in rules.items()
    ]
    counts += [
        f"SELECT '{t}.{'_'.join(k)}.unique', count(*) FROM (SELECT 1 FROM {source[t]} GROUP BY {', '.join(k)} HAVING count(*) > 1)"
        for t, keys in KEYS.items() for k in keys
    ]
    counts += [
        f"SELECT '{c}.{column}.reference', count(*) FROM {source[c]} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {source[p]} p WHERE p.{KEYS[p][0][0]} = c.{column})"
        for c, column, p in REFERENCES
    ]
    counts.append(
        f"""SELECT '{GAPS}', count(*) FROM assets_ a CROSS JOIN dates d
    LEFT JOIN fact_ f ON f.asset_id = a.asset_id AND f.date_id = d.date_id
    WHERE a.asset_type = 'stock' AND d.is_trading_day AND f.close IS NULL"""
    )
    counts.append(f"SELECT '{RECOMPUTED}', count(*) FROM metrics_ WHERE date_id % 100 = 14")
    damaged = """types_ AS (SELECT asset_type_id, name FROM types),
  assets_ AS (SELECT * REPLACE (CASE WHEN symbol = '5-LOW' THEN 'bond' ELSE source END AS source) FROM assets),
  fact_ AS (SELECT * REPLACE (CASE WHEN date_id % 100 = 7 THEN low ELSE high END AS high, CASE WHEN date_id % 100 = 9 THEN 77 ELSE asset_id END AS asset_id,
                              CASE WHEN date_id % 100 = 11 THEN -close ELSE close END AS close) FROM fact),
  metrics_ AS (SELECT a.asset_id, d.date_id, m.daily_return, m.rolling_vol_30d FROM metrics m JOIN assets a USING (symbol) JOIN dates d ON d.date = m.date)"""
    body = "\nUNION ALL ".join(counts)
    head = sql("SELECT 1", "types", "assets", "dates", "fact", "metrics").rsplit("SELECT 1", 1)[0].rstrip()
    return f"{head},\n  {damaged}\n{body}"


@query("gold_gate", _gate_sql())
def q_gold_gate(spark, sf_dir):
    """All gold checks over damaged tables: each fault is counted by its check."""
    g = Gold(spark, sf_dir)
    day = F.col("date_id") % 100
    metrics = g.metrics().withColumn("rolling_return_30d", F.col("rolling_return_30d") + F.when(day == 14, 0.25).otherwise(0.0))
    damaged = g.fact.withColumns({
        "high": F.when(day == 7, F.col("low")).otherwise(F.col("high")),
        "asset_id": F.when(day == 9, F.lit(77).cast("long")).otherwise(F.col("asset_id")),
        "close": F.when(day == 11, -F.col("close")).otherwise(F.col("close")),
    })
    tables = {
        "dim_asset_type": g.types,
        "dim_asset": g.assets.withColumn("source", F.when(F.col("symbol") == "5-LOW", "bond").otherwise(F.col("source"))),
        "dim_date": g.dates,
        "fact_daily_price": damaged,
        "fact_daily_metrics": metrics,
    }
    return gold_report(tables, halo=g.fact).select("test_name", "row_count")
