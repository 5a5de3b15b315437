"""Queries over window returns, investing, volatility and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions.dates import latest
from pricelake.operators.asof import asof_backward, asof_forward, last_value_at_or_before
from pricelake.operators.correlation import (
    benchmark_correlation,
    correlation_extremes,
    correlation_long,
    correlation_matrix,
)
from pricelake.operators.derived_series import lump_ranking
from pricelake.operators.investing import (
    buy_schedule,
    dca,
    dca_path,
    dca_vs_lump_sum,
    lump_sum_one_year,
)
from pricelake.operators.metrics import (
    rolling_returns,
    with_daily_returns,
    with_volatility,
)
from pricelake.operators.volatility import (
    volatility_extremes,
    volatility_rank,
    volatility_summary,
)
from pricelake.operators.window_returns import (
    returns_by_window,
    window_return,
    window_winners,
    ytd_return,
)
from pricelake.plans.adapters import (
    BENCHMARK,
    REFERENCE,
    prices,
    rounded,
    sql,
    table,
    type_prices,
)
from pricelake.plans.registry import query
from pricelake.schemas import ROLLING_DAYS

_SERIES = ["symbol", "asset_type", "date", "close"]


def answer_prices(spark, sf_dir):
    """The price frame the answers read; kept, because each answer reads it several times."""
    return prices(spark, sf_dir).select(*_SERIES).persist()


def answer_metrics(rows):
    """Returns and volatility of a (symbol, asset_type, date, close) frame."""
    out = with_volatility(with_daily_returns(rows, by=["symbol"]), by=["symbol"])
    return rolling_returns(out, by=["symbol"], windows=ROLLING_DAYS)


def window_table(rows):
    return returns_by_window(answer_metrics(rows), rows, benchmark=BENCHMARK)


@query(
    "last_value_asof",
    sql(
        """SELECT symbol,
    round(arg_max(rolling_return_30d, date) FILTER (WHERE date <= d - 5), 8) AS rolling_return_30d,
    round(arg_max(rolling_vol_30d, date) FILTER (WHERE date <= d - 5), 8) AS rolling_vol_30d
  FROM metrics, as_of_day GROUP BY symbol""",
        "metrics",
        "as_of_day",
    ),
)
def q_last_value_asof(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    columns = ["rolling_return_30d", "rolling_vol_30d"]
    out = last_value_at_or_before(answer_metrics(rows), columns, F.date_sub(latest(rows), 5))
    return rounded(out, 8, *columns)


def _between_sql(start: str) -> str:
    return f"""SELECT symbol, round(arg_max(close, date) FILTER (WHERE date BETWEEN {start} AND d)
    / arg_min(close, date) FILTER (WHERE date BETWEEN {start} AND d) - 1.0, 8) AS "return"
  FROM prices, as_of_day GROUP BY symbol, d"""


@query("ytd_return", sql(_between_sql("date_trunc('year', d)"), "prices", "as_of_day"))
def q_ytd_return(spark, sf_dir):
    return rounded(ytd_return(answer_prices(spark, sf_dir)), 8, "return")


@query("window_return", sql(_between_sql("d - 14"), "prices", "as_of_day"))
def q_window_return(spark, sf_dir):
    return rounded(window_return(answer_prices(spark, sf_dir), 14), 8, "return")


@query(
    "returns_by_window",
    sql(
        """SELECT "window", symbol, start_date, end_date, round("return", 8) AS "return",
    round(btc_return, 8) AS btc_return, beats_btc FROM rbw""",
        "rbw",
    ),
)
def q_returns_by_window(spark, sf_dir):
    return rounded(window_table(answer_prices(spark, sf_dir)), 8, "return", "btc_return")


@query(
    "volatility_summary",
    sql(
        """SELECT symbol, asset_type, round(daily_return_stdev, 6) AS daily_return_stdev, n_obs
  FROM vol""",
        "vol",
    ),
)
def q_volatility_summary(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"])
    return rounded(volatility_summary(rows), 6, "daily_return_stdev")


def _targets(spark, sf_dir):
    """Every line item asks for the price of its order's priority at the shipping date."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderpriority").alias("symbol"),
        F.to_date("l_shipdate").alias("target"),
    )


def _asof_sql(inequality: str) -> str:
    return f"""SELECT t.*, p.date AS fill_date, p.close AS fill_close
  FROM (SELECT l_orderkey, l_linenumber, o_orderpriority AS symbol,
               CAST(l_shipdate AS DATE) AS target
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
  ASOF LEFT JOIN prices p ON p.symbol = t.symbol AND p.date {inequality} t.target"""


@query("asof_forward", sql(_asof_sql(">="), "prices"))
def q_asof_forward(spark, sf_dir):
    return asof_forward(_targets(spark, sf_dir), prices(spark, sf_dir))


@query("asof_backward", sql(_asof_sql("<="), "prices"))
def q_asof_backward(spark, sf_dir):
    return asof_backward(_targets(spark, sf_dir), prices(spark, sf_dir))


_MONEY = ["units", "current_value_usd", "pnl_usd", "total_return"]


def _money_sql(source: str, others: str) -> str:
    cols = ", ".join(f"round({c}, 6) AS {c}" for c in _MONEY)
    return f"SELECT {others}, {cols} FROM {source}"


_LUMP_OTHERS = "symbol, principal_usd, start_date, end_date, start_price, end_price"


@query("lump_sum", sql(_money_sql("lump", _LUMP_OTHERS), "lump"))
def q_lump_sum(spark, sf_dir):
    return rounded(lump_sum_one_year(answer_prices(spark, sf_dir)), 6, *_MONEY)


@query("buy_schedule", sql("SELECT symbol, buy_no, target FROM schedule", "schedule"))
def q_buy_schedule(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    symbols = rows.select("symbol").distinct()
    return buy_schedule(symbols, months=12, start=F.date_sub(latest(rows), 365)).withColumn(
        "buy_no", F.col("buy_no").cast("long")
    )


@query(
    "dca_buys",
    sql(
        """SELECT symbol, buy_no, target, fill_date, price, round(units, 8) AS units FROM buys""",
        "buys",
    ),
)
def q_dca_buys(spark, sf_dir):
    from pricelake.operators.investing import dca_buys

    rows = answer_prices(spark, sf_dir)
    out = dca_buys(rows, monthly_amount_usd=100.0, months=12, start=F.date_sub(latest(rows), 365))
    return rounded(out, 8, "units").withColumn("buy_no", F.col("buy_no").cast("long"))


@query(
    "dca",
    sql(
        """SELECT symbol, 100.0::DOUBLE AS monthly_amount_usd, months,
    CAST(total_invested_usd AS DOUBLE) AS total_invested_usd, round(total_units, 8) AS total_units,
    final_price_usd, round(current_value_usd, 6) AS current_value_usd,
    round(current_value_usd - total_invested_usd, 6) AS pnl_usd,
    round((current_value_usd - total_invested_usd) / total_invested_usd, 6) AS total_return
  FROM dca_totals""",
        "dca_totals",
    ),
)
def q_dca(spark, sf_dir):
    rows = answer_prices(spark, sf_dir)
    out = dca(rows, monthly_amount_usd=100.0, months=12, start=F.date_sub(latest(rows), 365))
    out = rounded(out, 8, "total_units")
    return rounded(out, 6, "current_value_usd", "pnl_usd", "total_return")


@query(
    "dca_vs_lump",
    sql(_money_sql("strategies", "strategy, symbol, principal_usd, n_buys"), "strategies"),
)
def q_dca_vs_lump(spark, sf_dir):
    return rounded(dca_vs_lump_sum(answer_prices(spark, sf_dir)), 6, *_MONEY)


@query(
    "dca_path",
    sql(
        """SELECT p.symbol, p.date, round(sum(b.units) * any_value(p.close), 6) AS dca_value,
    CAST(count(*) * 100.0 AS DOUBLE) AS dca_invested,
    round(any_value(p.close) * 1200.0 / any_value(l.a), 6) AS lump_value
  FROM prices p JOIN buys b ON b.symbol = p.symbol AND b.fill_date <= p.date
  JOIN (SELECT symbol, arg_min(close, date) FILTER (WHERE date >= d - 365) AS a
        FROM prices, as_of_day GROUP BY symbol) l ON l.symbol = p.symbol
  GROUP BY p.symbol, p.date""",
        "prices",
        "buys",
        "as_of_day",
    ),
)
def q_dca_path(spark, sf_dir):
    out = dca_path(answer_prices(spark, sf_dir))
    return rounded(out, 6, "dca_value", "lump_value")


_CORR_SQL = """recent AS (SELECT symbol, date, daily_return FROM {metrics}
    WHERE date > (SELECT max(date) - 365 FROM {prices}) AND daily_return IS NOT NULL),
  moving AS (SELECT symbol FROM recent GROUP BY symbol HAVING stddev_samp(daily_return) > 0),
  kept AS (SELECT * FROM recent WHERE symbol IN (SELECT symbol FROM moving)),
  full_days AS (SELECT date FROM kept GROUP BY date
    HAVING count(*) = (SELECT count(*) FROM moving)),
  pairs AS (SELECT a.symbol, b.symbol AS other, corr(a.daily_return, b.daily_return) AS r,
      count(*) AS n_days
    FROM kept a JOIN kept b USING (date) WHERE date IN (SELECT date FROM full_days)
    GROUP BY 1, 2)"""


def _corr_statement(body: str, prices_name: str, metrics_name: str) -> str:
    extra = _CORR_SQL.format(metrics=metrics_name, prices=prices_name)
    return sql("", metrics_name).rstrip() + ",\n  " + extra + "\n" + body


_LONG_SQL = "SELECT symbol, other, round(r, 8) AS correlation, n_days FROM pairs"


@query("correlation_long", _corr_statement(_LONG_SQL, "prices", "metrics"))
def q_correlation_long(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"]).persist()
    return rounded(correlation_long(rows), 8, "correlation")


@query("correlation_blocks", _corr_statement(_LONG_SQL, "by_type", "type_metrics"))
def q_correlation_blocks(spark, sf_dir):
    """Series by part type, in blocks of two symbols."""
    rows = with_daily_returns(type_prices(spark, sf_dir), by=["symbol"]).persist()
    return rounded(correlation_long(rows, block_symbols=2), 8, "correlation")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "correlation_matrix",
    _corr_statement(
        "SELECT symbol, "
        + ", ".join(
            f"round(max(r) FILTER (WHERE other = '{p}'), 8) AS \"{p}\"" for p in _PRIORITIES
        )
        + " FROM pairs GROUP BY symbol",
        "prices",
        "metrics",
    ),
)
def q_correlation_matrix(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"]).persist()
    return rounded(correlation_matrix(correlation_long(rows), _PRIORITIES), 8, *_PRIORITIES)


@query(
    "corr_extremes",
    _corr_statement(
        f"""SELECT arg_max(symbol, abs(r)) AS strongest, round(arg_max(r, abs(r)), 8) AS strongest_r,
    arg_min(symbol, abs(r)) AS weakest, round(arg_min(r, abs(r)), 8) AS weakest_r
  FROM pairs WHERE other = '{BENCHMARK}' AND symbol <> '{BENCHMARK}' HAVING count(*) > 0""",
        "prices",
        "metrics",
    ),
)
def q_corr_extremes(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"]).persist()
    out = correlation_extremes(benchmark_correlation(rows, benchmark=BENCHMARK), benchmark=BENCHMARK)
    return rounded(out, 8, "strongest_r", "weakest_r")


@query(
    "window_winners",
    sql(
        """SELECT position, "window", winner, round("return", 8) AS "return",
    round(btc_return, 8) AS btc_return, beats_btc FROM winners""",
        "winners",
    ),
)
def q_window_winners(spark, sf_dir):
    out = window_winners(window_table(answer_prices(spark, sf_dir)), BENCHMARK)
    return rounded(out, 8, "return", "btc_return")


@query("lump_rank", sql(_money_sql("lump", "symbol") + " ORDER BY total_return DESC", "lump"))
def q_lump_rank(spark, sf_dir):
    out = lump_ranking(lump_sum_one_year(answer_prices(spark, sf_dir)))
    return rounded(out.select("symbol", *_MONEY), 6, *_MONEY)


_RANK_SQL = """SELECT row_number() OVER (ORDER BY daily_return_stdev DESC, symbol) AS rank, symbol,
    asset_type, round(daily_return_stdev, 6) AS daily_return_stdev,
    round(daily_return_stdev * sqrt(252.0) * 100.0, 4) AS annualised_pct,
    CASE WHEN symbol <> '{ref}' AND ref > 0 THEN round(daily_return_stdev / ref, 6) END AS multiple,
    n_obs
  FROM {vol}, (SELECT max(daily_return_stdev) FILTER (WHERE symbol = '{ref}') AS ref FROM {vol})"""


def _rank_out(out):
    out = rounded(out, 6, "daily_return_stdev", "multiple")
    return rounded(out, 4, "annualised_pct")


@query("vol_rank", sql(_RANK_SQL.format(ref=REFERENCE, vol="vol"), "vol"))
def q_vol_rank(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"])
    return _rank_out(volatility_rank(volatility_summary(rows).persist(), reference=REFERENCE))


@query(
    "vol_rank_parts",
    sql(
        "SELECT * FROM ("
        + _RANK_SQL.format(
            ref="P1",
            vol="""(SELECT symbol, asset_type, stddev_samp(daily_return) AS daily_return_stdev,
      count(daily_return) AS n_obs FROM part_metrics
      WHERE daily_return IS NOT NULL GROUP BY 1, 2)""",
        )
        + ")",
        "part_metrics",
    ),
)
def q_vol_rank_parts(spark, sf_dir):
    """A ranking of many symbols."""
    from pricelake.plans.adapters import part_prices

    rows = with_daily_returns(part_prices(spark, sf_dir), by=["symbol"])
    return _rank_out(volatility_rank(volatility_summary(rows, lookback_days=10_000), reference="P1"))


@query(
    "vol_extremes",
    sql(
        f"""SELECT arg_max(symbol, daily_return_stdev) AS most_volatile,
    round(max(daily_return_stdev) * sqrt(252.0) * 100.0, 4) AS most_annualised_pct,
    arg_min(symbol, daily_return_stdev) AS least_volatile,
    round(min(daily_return_stdev) * sqrt(252.0) * 100.0, 4) AS least_annualised_pct,
    count(*) AS symbols,
    (SELECT count(*) + 1 FROM vol WHERE daily_return_stdev >
       (SELECT daily_return_stdev FROM vol WHERE symbol = '{BENCHMARK}')) AS benchmark_rank
  FROM vol""",
        "vol",
    ),
)
def q_vol_extremes(spark, sf_dir):
    rows = with_daily_returns(answer_prices(spark, sf_dir), by=["symbol"])
    out = volatility_extremes(volatility_summary(rows).persist(), benchmark=BENCHMARK)
    return rounded(out, 4, "most_annualised_pct", "least_annualised_pct")
