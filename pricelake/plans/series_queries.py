"""Queries over the report series and one-row summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators.derived_series import (
    assets_present,
    basket_spread,
    beat_count,
    best_worst,
    growth_of_principal,
    kpi_row,
    rebased_change,
    report_counts,
    return_grid,
    risk_return,
    rolling_vol_annual,
    strategy_gap,
)
from pricelake.operators.investing import dca_vs_lump_sum, lump_sum_one_year
from pricelake.operators.metrics import with_daily_returns, with_volatility
from pricelake.operators.volatility import volatility_summary
from pricelake.operators.window_returns import window_winners
from pricelake.plans.adapters import BENCHMARK, REFERENCE, rounded, sql
from pricelake.plans.answer_queries import answer_prices, window_table
from pricelake.plans.registry import query
from pricelake.schemas import WINDOW_ORDER

_BASE_SQL = """SELECT symbol, date, close,
    first_value(close) OVER (PARTITION BY symbol ORDER BY date) AS base
  FROM prices, as_of_day WHERE date BETWEEN d - 365 AND d"""


@query(
    "rebased_change",
    sql(
        f"""SELECT symbol, date, round((close / base - 1.0) * 100.0, 6) AS change_pct
  FROM ({_BASE_SQL}) WHERE base <> 0""",
        "prices",
        "as_of_day",
    ),
)
def q_rebased_change(spark, sf_dir):
    return rounded(rebased_change(answer_prices(spark, sf_dir)), 6, "change_pct")


@query(
    "growth_of_principal",
    sql(
        f"""SELECT symbol, date, round(close / base * 1000.0, 6) AS value_usd
  FROM ({_BASE_SQL}) WHERE base <> 0""",
        "prices",
        "as_of_day",
    ),
)
def q_growth_of_principal(spark, sf_dir):
    return rounded(growth_of_principal(answer_prices(spark, sf_dir)), 6, "value_usd")


@query(
    "rolling_vol_annual",
    sql(
        """SELECT symbol, date, round(rolling_vol_30d * sqrt(252.0) * 100.0, 4) AS annualised_pct
  FROM metrics, as_of_day WHERE date BETWEEN d - 365 AND d AND rolling_vol_30d IS NOT NULL""",
        "metrics",
        "as_of_day",
    ),
)
def q_rolling_vol_annual(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    metrics = with_volatility(with_daily_returns(rows, by=["symbol"]), by=["symbol"])
    return rounded(rolling_vol_annual(metrics), 4, "annualised_pct")


@query(
    "return_grid",
    sql(
        "SELECT symbol, "
        + ", ".join(
            f"""round(max("return") FILTER (WHERE "window" = '{w}') * 100.0, 6) AS "{w}\""""
            for w in WINDOW_ORDER
        )
        + " FROM rbw GROUP BY symbol",
        "rbw",
    ),
)
def q_return_grid(spark, sf_dir):
    return rounded(return_grid(window_table(answer_prices(spark, sf_dir))), 6, *WINDOW_ORDER)


@query(
    "beat_count",
    sql(
        """SELECT count(*) FILTER (WHERE beats_btc) AS beats, count(*) AS total,
    max(winner) FILTER (WHERE "window" = '1y') AS year_winner,
    round(max("return") FILTER (WHERE "window" = '1y'), 8) AS year_return,
    round(max(coalesce(btc_return, 0.0)) FILTER (WHERE "window" = '1y'), 8) AS year_btc_return
  FROM winners""",
        "winners",
    ),
)
def q_beat_count(spark, sf_dir):
    winners = window_winners(window_table(answer_prices(spark, sf_dir)), BENCHMARK)
    return rounded(beat_count(winners), 8, "year_return", "year_btc_return")


@query(
    "best_worst",
    sql(
        f"""SELECT arg_max(symbol, total_return) AS best_symbol,
    round(max(total_return), 6) AS best_return, arg_min(symbol, total_return) AS worst_symbol,
    round(min(total_return), 6) AS worst_return,
    round(max(current_value_usd) FILTER (WHERE symbol = '{BENCHMARK}'), 6) AS benchmark_value_usd,
    round(max(total_return) FILTER (WHERE symbol = '{BENCHMARK}'), 6) AS benchmark_return
  FROM lump""",
        "lump",
    ),
)
def q_best_worst(spark, sf_dir):
    out = best_worst(lump_sum_one_year(answer_prices(spark, sf_dir)), benchmark=BENCHMARK)
    return rounded(
        out, 6, "best_return", "worst_return", "benchmark_value_usd", "benchmark_return"
    )


_GAP_SQL = """SELECT l.symbol, l.current_value_usd AS lump_value_usd,
    c.current_value_usd AS dca_value_usd, l.current_value_usd - c.current_value_usd AS gap,
    l.principal_usd
  FROM strategies l JOIN strategies c USING (symbol)
  WHERE l.strategy = 'lump_sum' AND c.strategy = 'dca'"""


@query(
    "strategy_gap",
    sql(
        f"""SELECT symbol, round(lump_value_usd, 6) AS lump_value_usd,
    round(dca_value_usd, 6) AS dca_value_usd, round(gap, 6) AS gap_usd,
    CASE WHEN gap > 0 THEN 'lump_sum' ELSE 'dca' END AS winner,
    round(abs(gap) / principal_usd * 100.0, 6) AS edge_pct
  FROM ({_GAP_SQL})""",
        "strategies",
    ),
)
def q_strategy_gap(spark, sf_dir):
    out = strategy_gap(dca_vs_lump_sum(answer_prices(spark, sf_dir)))
    return rounded(out, 6, "lump_value_usd", "dca_value_usd", "gap_usd", "edge_pct")


@query(
    "risk_return",
    sql(
        """SELECT symbol, round(total_return * 100.0, 6) AS return_pct,
    round(daily_return_stdev * sqrt(252.0) * 100.0, 4) AS annualised_pct
  FROM vol JOIN lump USING (symbol)""",
        "vol",
        "lump",
    ),
)
def q_risk_return(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    vol = volatility_summary(with_daily_returns(rows, by=["symbol"]))
    out = risk_return(vol, lump_sum_one_year(rows))
    return rounded(rounded(out, 6, "return_pct"), 4, "annualised_pct")


@query(
    "basket_spread",
    sql(
        f"""SELECT round(b, 6) AS benchmark_return, round(o, 6) AS basket_return,
    round((o - b) * 100.0, 6) AS spread_points
  FROM (SELECT max(total_return) FILTER (WHERE symbol = '{BENCHMARK}') AS b,
               avg(total_return) FILTER (WHERE symbol <> '{BENCHMARK}') AS o FROM lump)""",
        "lump",
    ),
)
def q_basket_spread(spark, sf_dir):
    out = basket_spread(lump_sum_one_year(answer_prices(spark, sf_dir)), benchmark=BENCHMARK)
    return rounded(out, 6, "benchmark_return", "basket_return", "spread_points")


@query(
    "report_counts",
    sql(
        f"""SELECT count(DISTINCT symbol) AS symbols,
    (SELECT count(DISTINCT "window") FROM rbw) AS windows,
    coalesce(nullif(count(*) FILTER (WHERE symbol = '{BENCHMARK}' AND date >= d - 365), 0),
      count(*) FILTER (WHERE symbol <> 'USD')) AS trading_days
  FROM prices, as_of_day""",
        "prices",
        "as_of_day",
        "rbw",
    ),
)
def q_report_counts(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    return report_counts(rows, window_table(rows), benchmark=BENCHMARK)


@query(
    "kpi_row",
    sql(
        f"""SELECT round(max(l.total_return) FILTER (WHERE l.symbol = '{BENCHMARK}'), 6) AS benchmark_return,
    round(max(l.current_value_usd) FILTER (WHERE l.symbol = '{BENCHMARK}'), 6)
      AS benchmark_value_usd,
    arg_max(l.symbol, l.total_return) AS best_symbol, round(max(l.total_return), 6) AS best_return,
    round(arg_max(l.current_value_usd, l.total_return), 6) AS best_value_usd,
    any_value(CASE WHEN g.gap > 0 THEN 'lump_sum' ELSE 'dca' END) AS strategy_winner,
    round(any_value(abs(g.gap)), 6) AS strategy_gap_usd,
    round(any_value(abs(g.gap) / g.principal_usd * 100.0), 6) AS strategy_edge_pct,
    round(any_value(s.own) * 100.0, 4) AS benchmark_sigma_pct,
    round(any_value(s.own / s.ref), 6) AS sigma_multiple
  FROM lump l, (SELECT * FROM ({_GAP_SQL}) WHERE symbol = '{BENCHMARK}') g,
    (SELECT max(daily_return_stdev) FILTER (WHERE symbol = '{BENCHMARK}') AS own,
            max(daily_return_stdev) FILTER (WHERE symbol = '{REFERENCE}') AS ref FROM vol) s""",
        "lump",
        "strategies",
        "vol",
    ),
)
def q_kpi_row(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    out = kpi_row(
        lump_sum_one_year(rows),
        dca_vs_lump_sum(rows),
        volatility_summary(with_daily_returns(rows, by=["symbol"])),
        benchmark=BENCHMARK,
        reference=REFERENCE,
    )
    money = ["benchmark_return", "benchmark_value_usd", "best_return", "best_value_usd"]
    out = rounded(out, 6, *money, "strategy_gap_usd", "strategy_edge_pct", "sigma_multiple")
    return rounded(out, 4, "benchmark_sigma_pct")


@query(
    "assets_present",
    sql(
        f"""SELECT CASE WHEN symbol = '{BENCHMARK}' THEN -1 ELSE ordinal END::BIGINT AS position, symbol,
    coalesce(name, symbol) AS name
  FROM (SELECT DISTINCT symbol FROM prices)
  LEFT JOIN (VALUES (0, '5-LOW', 'Low'), (1, '2-HIGH', 'High'), (2, '9-NONE', 'None'),
    (3, '{BENCHMARK}', 'Urgent')) c(ordinal, symbol, name) USING (symbol)
  WHERE ordinal IS NOT NULL OR symbol = '{BENCHMARK}'""",
        "prices",
    ),
)
def q_assets_present(spark, sf_dir):
    catalog = spark.sql(
        f"""SELECT * FROM VALUES (0, '5-LOW', 'Low'), (1, '2-HIGH', 'High'), (2, '9-NONE', 'None'),
        (3, '{BENCHMARK}', 'Urgent') AS c(ordinal, symbol, name)"""
    )
    rows = answer_prices(spark, sf_dir)
    return assets_present(rows, catalog, benchmark=BENCHMARK).withColumn(
        "position", F.col("position").cast("long")
    )
