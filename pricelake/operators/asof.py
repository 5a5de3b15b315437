"""As-of lookups: the price in force at a date, or the next one after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date


def last_value_at_or_before(df: DataFrame, columns: list[str], as_of) -> DataFrame:
    """Latest non-null value of each column per symbol on or before ``as_of``."""
    kept = df.where(F.col("date") <= as_date(as_of))
    return kept.groupBy("symbol").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in columns]
    )


def price_on_or_after(prices: DataFrame, target) -> DataFrame:
    """First (date, close) per symbol on or after one target date."""
    return (
        prices.where(F.col("date") >= as_date(target))
        .groupBy("symbol")
        .agg(F.min("date").alias("date"), F.min_by("close", "date").alias("close"))
    )


def latest_price(prices: DataFrame, as_of) -> DataFrame:
    """Last (date, close) per symbol on or before ``as_of``."""
    return (
        prices.where(F.col("date") <= as_date(as_of))
        .groupBy("symbol")
        .agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))
    )


def _asof(targets: DataFrame, prices: DataFrame, target: str, forward: bool) -> DataFrame:
    """Fill every target row with a price row of its symbol; unmatched targets get nulls.

    Only the distinct (symbol, date) targets are merged with the prices, so the ordered
    window sees at most two rows per symbol and calendar day however many targets a hot
    symbol has. The filled dates are then joined back on (symbol, date); a hot date is
    split there by the adaptive skew join.
    """
    days = targets.select("symbol", F.col(target).alias("_day")).distinct()
    marks = days.select(
        "symbol", "_day", F.lit(1).alias("_is_target"), F.lit(None).cast("date").alias("fill_date"),
        F.lit(None).cast("double").alias("fill_close"),
    )
    known = prices.select(
        "symbol", F.col("date").alias("_day"), F.lit(0).alias("_is_target"),
        F.col("date").alias("fill_date"), F.col("close").alias("fill_close"),
    )
    day = F.col("_day").desc() if forward else F.col("_day").asc()
    # prices come before targets of the same day, so the running last price covers equality
    seen = (
        W.partitionBy("symbol").orderBy(day, "_is_target").rowsBetween(W.unboundedPreceding, 0)
    )
    filled = (
        known.unionByName(marks)
        .withColumns(
            {c: F.last(c, ignorenulls=True).over(seen) for c in ("fill_date", "fill_close")}
        )
        .where((F.col("_is_target") == 1) & F.col("fill_date").isNotNull())
        .select("symbol", F.col("_day").alias(target), "fill_date", "fill_close")
    )
    return targets.join(filled, ["symbol", target], "left").select(
        *targets.columns, "fill_date", "fill_close"
    )


def asof_forward(targets: DataFrame, prices: DataFrame, target: str = "target") -> DataFrame:
    """Add the first price on or after each target (fill_date, fill_close)."""
    return _asof(targets, prices, target, forward=True)


def asof_backward(targets: DataFrame, prices: DataFrame, target: str = "target") -> DataFrame:
    """Add the last price on or before each target (fill_date, fill_close)."""
    return _asof(targets, prices, target, forward=False)
