"""Pearson correlation of daily returns between all symbols."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.volatility import recent_returns

# Symbols per side of a block; a block pair works on twice as many vectors, each no
# longer than the look-back, whatever the number of symbols.
BLOCK_SYMBOLS = 512


def _aligned_returns(metrics: DataFrame, lookback_days: int, as_of) -> DataFrame:
    """Returns of non-flat symbols on the dates every one of them has."""
    recent = recent_returns(metrics, lookback_days=lookback_days, as_of=as_of).select(
        "symbol", "date", "daily_return"
    )
    moving = (
        recent.groupBy("symbol")
        .agg(F.stddev_samp("daily_return").alias("s"))
        .where(F.col("s") > 0)
        .select("symbol")
    )
    kept = recent.join(moving, "symbol", "left_semi")
    symbols = moving.agg(F.count(F.lit(1))).scalar()
    full_days = kept.groupBy("date").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == symbols)
    return kept.join(full_days.select("date"), "date", "left_semi")


def correlation_long(
    metrics: DataFrame,
    *,
    lookback_days: int = 365,
    as_of=None,
    block_symbols: int = BLOCK_SYMBOLS,
) -> DataFrame:
    """(symbol, other, correlation, n_days), both orders and the diagonal.

    A self join on the date would put symbols^2 rows per date into a shuffle. Instead each
    symbol becomes one vector (at most ``lookback_days`` values), vectors are hashed into
    blocks, and every pair of blocks is one matrix product; the only quadratic thing is
    the answer itself. Symbols without a common date give no rows.
    """
    vectors = (
        _aligned_returns(metrics, lookback_days, as_of)
        .groupBy("symbol")
        .agg(F.array_sort(F.collect_list(F.struct("date", "daily_return"))).alias("v"))
        .select("symbol", F.col("v.daily_return").alias("v"))
    )
    blocks = vectors.agg(F.ceil(F.count(F.lit(1)) / F.lit(block_symbols)).cast("int")).scalar()
    placed = vectors.withColumn("_n", blocks).withColumn(
        "_own", F.pmod(F.xxhash64("symbol"), F.col("_n")).cast("int")
    )
    sent = placed.withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    ).select(
        F.least("_own", "_other").alias("low"),
        F.greatest("_own", "_other").alias("high"),
        F.col("_own").alias("own"),
        "symbol",
        "v",
    )
    return sent.groupBy("low", "high").applyInPandas(
        _block_correlator(), "symbol string, other string, correlation double, n_days long"
    )


def _block_correlator():
    """The per-block function, as a closure: it travels to the workers by value, so they
    need numpy and pandas but not this package."""

    def cells(rows: np.ndarray, cols: np.ndarray, m: np.ndarray, days: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "symbol": np.repeat(rows, len(cols)),
                "other": np.tile(cols, len(rows)),
                "correlation": m.ravel(),
                "n_days": days,
            }
        )

    def correlate(pair: pd.DataFrame) -> pd.DataFrame:
        low, high = int(pair["low"].iloc[0]), int(pair["high"].iloc[0])
        x = np.array(pair["v"].tolist(), dtype=float)
        days = x.shape[1]
        x = x - x.mean(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        with np.errstate(divide="ignore", invalid="ignore"):
            x = x / norm
        names = pair["symbol"].to_numpy()
        own = pair["own"].to_numpy()
        a, b = own == low, own == high
        r = np.clip(x[a] @ x[b].T, -1.0, 1.0)
        out = cells(names[a], names[b], r, days)
        if low == high:
            return out
        return pd.concat([out, cells(names[b], names[a], r.T, days)], ignore_index=True)

    return correlate


def correlation_matrix(long: DataFrame, symbols: list[str]) -> DataFrame:
    """Wide form: one column for each of the symbols, which the caller names so that no job collects them."""
    return long.groupBy("symbol").pivot("other", symbols).agg(F.first("correlation"))


def benchmark_correlation(
    metrics: DataFrame, *, benchmark: str, lookback_days: int = 365, as_of=None
) -> DataFrame:
    """(other, symbol, correlation) with one symbol: as ``correlation_long``, without the other pairs."""
    recent = _aligned_returns(metrics, lookback_days, as_of)
    own = recent.where(F.col("symbol") == benchmark).select("date", F.col("daily_return").alias("_own"))
    return (
        recent.join(own, "date")
        .groupBy("symbol")
        .agg(F.corr("daily_return", "_own").alias("correlation"))
        .select(F.lit(benchmark).alias("other"), "symbol", "correlation")
    )


def correlation_extremes(long: DataFrame, *, benchmark: str) -> DataFrame:
    """Strongest and weakest correlation with the benchmark by absolute value. One row."""
    size = F.abs("correlation")
    return (
        long.where((F.col("other") == benchmark) & (F.col("symbol") != benchmark))
        .agg(
            F.min_by(F.struct("symbol", "correlation"), F.struct(-size, "symbol")).alias("s"),
            F.max_by(F.struct("symbol", "correlation"), F.struct(-size, "symbol")).alias("w"),
        )
        .where(F.col("s").isNotNull())
        .select(
            F.col("s.symbol").alias("strongest"),
            F.col("s.correlation").alias("strongest_r"),
            F.col("w.symbol").alias("weakest"),
            F.col("w.correlation").alias("weakest_r"),
        )
    )
