"""Tables behind the reports: rebased series, grids, one-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.functions.dates import resolve_as_of
from pricelake.functions.returns import annualised_percent
from pricelake.schemas import WINDOW_ORDER


def _with_base(prices: DataFrame, days: int, as_of) -> DataFrame:
    """Rows of [as_of - days, as_of] with the symbol's first close there; zero bases dropped.

    The window frame holds one row per calendar day of the look-back at most.
    """
    end = resolve_as_of(as_of, prices)
    first = W.partitionBy("symbol").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return (
        prices.where(F.col("date").between(F.date_sub(end, days), end))
        .select("symbol", "date", "close", F.first("close").over(first).alias("_base"))
        .where(F.col("_base") != 0)
        .withColumn("_ratio", F.col("close") / F.nullif("_base", F.lit(0.0)))
    )


def rebased_change(prices: DataFrame, *, days: int = 365, as_of=None) -> DataFrame:
    """Percent change since the first close of the look-back."""
    return _with_base(prices, days, as_of).select(
        "symbol", "date", ((F.col("_ratio") - 1.0) * 100.0).alias("change_pct")
    )


def growth_of_principal(
    prices: DataFrame, *, principal_usd: float = 1000.0, days: int = 365, as_of=None
) -> DataFrame:
    """Value of a principal invested at the first close of the look-back."""
    return _with_base(prices, days, as_of).select(
        "symbol", "date", (F.col("_ratio") * F.lit(float(principal_usd))).alias("value_usd")
    )


def rolling_vol_annual(
    metrics: DataFrame, *, column: str = "rolling_vol_30d", days: int = 365, as_of=None
) -> DataFrame:
    """Rolling volatility as yearly percent over the look-back."""
    end = resolve_as_of(as_of, metrics)
    return metrics.where(
        F.col("date").between(F.date_sub(end, days), end) & F.col(column).isNotNull()
    ).select("symbol", "date", annualised_percent(F.col(column)).alias("annualised_pct"))


def return_grid(returns: DataFrame) -> DataFrame:
    """One row per symbol, one percent column per canonical window."""
    return (
        returns.groupBy("symbol")
        .pivot("window", WINDOW_ORDER)
        .agg(F.first(F.col("return") * 100.0, ignorenulls=True))
    )


def beat_count(winners: DataFrame) -> DataFrame:
    """How often the window's winner beat the benchmark, and the one-year winner."""
    year = F.when(F.col("window") == "1y", F.lit(1))
    return winners.where(F.col("window").isin(WINDOW_ORDER)).agg(
        F.count_if("beats_btc").alias("beats"),
        F.count(F.lit(1)).alias("total"),
        F.max_by("winner", year).alias("year_winner"),
        F.max_by("return", year).alias("year_return"),
        F.max_by(F.coalesce("btc_return", F.lit(0.0)), year).alias("year_btc_return"),
    )


def lump_ranking(lump: DataFrame) -> DataFrame:
    """Lump-sum outcomes, best first (a distributed sort)."""
    return lump.orderBy(F.desc_nulls_last("total_return"), "symbol")


def best_worst(lump: DataFrame, *, benchmark: str) -> DataFrame:
    """Best, worst and benchmark outcome. One row."""
    r = F.col("total_return")
    high = F.when(r.isNotNull(), F.struct(-r, "symbol"))
    low = F.when(r.isNotNull(), F.struct(r, "symbol"))
    own = F.when(F.col("symbol") == benchmark, 1)
    return lump.agg(
        F.min_by("symbol", high).alias("best_symbol"),
        F.max(r).alias("best_return"),
        F.min_by("symbol", low).alias("worst_symbol"),
        F.min(r).alias("worst_return"),
        F.max_by("current_value_usd", own).alias("benchmark_value_usd"),
        F.max_by("total_return", own).alias("benchmark_return"),
    )


def strategy_gap(strategies: DataFrame) -> DataFrame:
    """Lump sum minus periodic value per symbol; only where both strategies exist."""

    def of(strategy: str, column: str) -> Column:
        return F.max(F.when(F.col("strategy") == strategy, F.col(column)))

    diff = F.col("lump_value_usd") - F.col("dca_value_usd")
    return (
        strategies.groupBy("symbol")
        .agg(
            of("lump_sum", "current_value_usd").alias("lump_value_usd"),
            of("dca", "current_value_usd").alias("dca_value_usd"),
            of("lump_sum", "principal_usd").alias("principal_usd"),
        )
        .where(F.col("lump_value_usd").isNotNull() & F.col("dca_value_usd").isNotNull())
        .select(
            "symbol",
            "lump_value_usd",
            "dca_value_usd",
            diff.alias("gap_usd"),
            F.when(diff > 0, "lump_sum").otherwise("dca").alias("winner"),
            F.coalesce(
                F.abs(diff) / F.nullif("principal_usd", F.lit(0.0)) * 100.0, F.lit(0.0)
            ).alias("edge_pct"),
        )
    )


def risk_return(vol: DataFrame, lump: DataFrame) -> DataFrame:
    """Yearly volatility against total return, both in percent."""
    return vol.join(lump.select("symbol", "total_return"), "symbol").select(
        "symbol",
        (F.col("total_return") * 100.0).alias("return_pct"),
        annualised_percent(F.col("daily_return_stdev")).alias("annualised_pct"),
    )


def basket_spread(lump: DataFrame, *, benchmark: str) -> DataFrame:
    """Benchmark return, mean return of all others, spread in points. One row."""
    own = F.col("symbol") == benchmark
    return lump.agg(
        F.max(F.when(own, F.col("total_return"))).alias("benchmark_return"),
        F.avg(F.when(~own, F.col("total_return"))).alias("basket_return"),
    ).withColumn(
        "spread_points", (F.col("basket_return") - F.col("benchmark_return")) * 100.0
    )


def report_counts(
    prices: DataFrame,
    returns: DataFrame,
    *,
    benchmark: str,
    flat_symbol: str = "USD",
    days: int = 365,
    as_of=None,
) -> DataFrame:
    """Symbols, windows, benchmark days of the look-back (or all non-flat rows if none)."""
    end = resolve_as_of(as_of, prices)
    in_window = (F.col("symbol") == benchmark) & F.col("date").between(F.date_sub(end, days), end)
    windows = returns.agg(F.count_distinct("window")).scalar()
    return (
        prices.withColumn("_in", in_window)
        .agg(
            F.count_distinct("symbol").alias("symbols"),
            F.count_if("_in").alias("_days"),
            F.count_if(F.col("symbol") != flat_symbol).alias("_rows"),
        )
        .select(
            "symbols",
            windows.alias("windows"),
            F.coalesce(F.nullif("_days", F.lit(0).cast("long")), F.col("_rows")).alias("trading_days"),
        )
    )


def kpi_row(
    lump: DataFrame,
    strategies: DataFrame,
    vol: DataFrame,
    *,
    benchmark: str,
    reference: str,
    strategy_symbol: str | None = None,
) -> DataFrame:
    """Headline numbers in one row, put together from one-row subqueries."""
    chosen = strategy_symbol or benchmark
    gap = strategy_gap(strategies.where(F.col("symbol") == chosen))
    gap = gap.agg(F.max(F.struct("winner", F.abs("gap_usd").alias("gap"), "edge_pct"))).scalar()
    sigma = F.col("daily_return_stdev")
    sigmas = vol.agg(
        F.struct(
            F.max(F.when(F.col("symbol") == benchmark, sigma)).alias("own"),
            F.max(F.when(F.col("symbol") == reference, sigma)).alias("ref"),
        )
    ).scalar()
    base = best_worst(lump, benchmark=benchmark)
    best_value = lump.where(F.col("total_return").isNotNull()).agg(
        F.min_by("current_value_usd", F.struct(-F.col("total_return"), "symbol"))
    ).scalar()
    return (
        base.withColumns({"_gap": gap, "_sigma": sigmas, "best_value_usd": best_value})
        .select(
            "benchmark_return",
            "benchmark_value_usd",
            "best_symbol",
            "best_return",
            "best_value_usd",
            F.col("_gap.winner").alias("strategy_winner"),
            F.col("_gap.gap").alias("strategy_gap_usd"),
            F.col("_gap.edge_pct").alias("strategy_edge_pct"),
            (F.col("_sigma.own") * 100.0).alias("benchmark_sigma_pct"),
            (F.col("_sigma.own") / F.nullif(F.col("_sigma.ref"), F.lit(0.0))).alias("sigma_multiple"),
        )
    )


def assets_present(prices: DataFrame, catalog: DataFrame, *, benchmark: str) -> DataFrame:
    """Catalog assets that have prices, benchmark first, then catalog order.

    ``catalog`` is (ordinal, symbol, name). A benchmark the catalog lacks is listed too.
    """
    present = prices.select("symbol").distinct()
    listed = present.join(catalog.select("ordinal", "symbol", "name"), "symbol", "left").where(
        F.col("ordinal").isNotNull() | (F.col("symbol") == benchmark)
    )
    place = F.when(F.col("symbol") == benchmark, -1).otherwise(F.col("ordinal"))
    return listed.select(
        place.cast("long").alias("position"), "symbol", F.coalesce("name", "symbol").alias("name")
    )
