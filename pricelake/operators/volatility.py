"""Volatility of daily returns and its ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import resolve_as_of
from pricelake.functions.returns import annualised_percent
from pricelake.operators.numbering import number_rows


def recent_returns(metrics: DataFrame, *, lookback_days: int, as_of=None) -> DataFrame:
    """Known daily returns in (as_of - lookback, as_of]: open on the left."""
    end = resolve_as_of(as_of, metrics)
    return metrics.where(
        (F.col("date") > F.date_sub(end, lookback_days))
        & (F.col("date") <= end)
        & F.col("daily_return").isNotNull()
    )


def volatility_summary(metrics: DataFrame, *, lookback_days: int = 365, as_of=None) -> DataFrame:
    """Sample deviation and count of daily returns per (symbol, asset_type)."""
    return (
        recent_returns(metrics, lookback_days=lookback_days, as_of=as_of)
        .groupBy("symbol", "asset_type")
        .agg(
            F.stddev_samp("daily_return").alias("daily_return_stdev"),
            F.count("daily_return").alias("n_obs"),
        )
    )


def volatility_rank(vol: DataFrame, *, reference: str) -> DataFrame:
    """Rank by deviation (largest first, unknown last), yearly percent, multiple of a symbol.

    The multiple is null for the reference itself and when it is absent or not positive.
    Deviations are ordered to 12 decimals: their last digits depend on how rows were summed.
    """
    sigma = F.col("daily_return_stdev")
    order = [sigma.isNull(), -F.round(sigma, 12), F.col("symbol"), F.col("asset_type")]
    base = vol.where(F.col("symbol") == reference).agg(F.max("daily_return_stdev")).scalar()
    return (
        number_rows(vol, order, "rank")
        .withColumn("_base", base)
        .select(
            "rank",
            "symbol",
            "asset_type",
            "daily_return_stdev",
            annualised_percent(sigma).alias("annualised_pct"),
            F.when(
                (F.col("symbol") != reference) & (F.col("_base") > 0),
                sigma / F.nullif("_base", F.lit(0.0)),
            ).alias("multiple"),
            "n_obs",
        )
    )


def volatility_extremes(vol: DataFrame, *, benchmark: str) -> DataFrame:
    """Most and least volatile symbol, and the benchmark's rank among all. One row."""
    sigma = F.col("daily_return_stdev")
    known = sigma.isNotNull()
    own = vol.where(F.col("symbol") == benchmark).agg(F.max("daily_return_stdev")).scalar()
    return (
        vol.withColumn("_own", own)
        .agg(
            F.min_by("symbol", F.when(known, F.struct(-sigma, "symbol"))).alias("most_volatile"),
            F.max(annualised_percent(sigma)).alias("most_annualised_pct"),
            F.min_by("symbol", F.when(known, F.struct(sigma, "symbol"))).alias("least_volatile"),
            F.min(annualised_percent(sigma)).alias("least_annualised_pct"),
            F.count(F.lit(1)).alias("symbols"),
            (
                F.count_if(
                    (sigma > F.col("_own"))
                    | ((sigma == F.col("_own")) & (F.col("symbol") < benchmark))
                )
                + 1
            ).alias("_place"),
            F.max("_own").alias("_own"),
        )
        .withColumn("benchmark_rank", F.when(F.col("_own").isNotNull(), F.col("_place")))
        .drop("_own", "_place")
    )
