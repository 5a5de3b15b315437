"""What to fetch next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date


def latest_date_per_symbol(prices: DataFrame) -> DataFrame:
    return prices.groupBy("symbol").agg(F.max("date").alias("latest"))


def _bounds(newest: Column, start, end, today, lookback_days: int) -> list[Column]:
    now = as_date(today)
    explicit = start is not None or end is not None
    first = (
        as_date(start)
        if start is not None
        else F.coalesce(F.date_add(newest, 1), F.date_sub(now, lookback_days))
    )
    last = as_date(end) if end is not None else F.date_sub(now, 1)
    idle = F.lit(False) if explicit else first > last
    return [first.alias("start"), last.alias("end"), idle.alias("up_to_date")]


def ingest_window(
    prices: DataFrame, *, today, lookback_days: int, start=None, end=None
) -> DataFrame:
    """One row (start, end, up_to_date).

    An explicit start wins; otherwise the day after the newest stored date over all
    symbols; otherwise ``today - lookback_days``. The end defaults to yesterday. Being
    up to date is only concluded when neither bound was asked for.
    """
    newest = prices.agg(F.max("date").alias("newest"))
    return newest.select(*_bounds(F.col("newest"), start, end, today, lookback_days))


def ingest_window_per_symbol(
    prices: DataFrame, symbols: DataFrame, *, today, lookback_days: int
) -> DataFrame:
    """The same per symbol, so that a lagging one catches up; new symbols look back."""
    newest = latest_date_per_symbol(prices)
    return (
        symbols.select("symbol")
        .distinct()
        .join(newest, "symbol", "left")
        .select("symbol", *_bounds(F.col("latest"), None, None, today, lookback_days))
    )


def symbol_ranges(prices: DataFrame) -> DataFrame:
    return prices.groupBy("symbol").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count(F.lit(1)).alias("n"),
    )


def backfill_span(prices: DataFrame, *, today) -> DataFrame:
    """Overall span to fetch again: earliest stored date to yesterday; empty if no data."""
    return (
        symbol_ranges(prices)
        .agg(
            F.min("min_date").alias("start"),
            F.count(F.lit(1)).alias("symbols"),
            F.sum("n").alias("rows"),
        )
        .where(F.col("start").isNotNull())
        .select("start", F.date_sub(as_date(today), 1).alias("end"), "symbols", "rows")
    )


def rows_by_source(rows: DataFrame) -> DataFrame:
    """One row with a JSON object source -> row count."""
    return (
        rows.groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.to_json(
                F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n"))))
            ).alias("rows_by_source")
        )
    )
