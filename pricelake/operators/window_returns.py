"""Returns per named window, against a benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date, resolve_as_of
from pricelake.functions.returns import change
from pricelake.operators.asof import last_value_at_or_before
from pricelake.operators.metrics import rolling_column
from pricelake.schemas import WINDOW_DAYS, WINDOW_ORDER


def _between(start: Column, end: Column) -> Column:
    return change(
        F.max_by("close", F.when(F.col("date").between(start, end), F.col("date"))),
        F.min_by("close", F.when(F.col("date").between(start, end), F.col("date"))),
    )


def _return_between(prices: DataFrame, start: Column, end: Column, symbols: DataFrame | None) -> DataFrame:
    if symbols is None:
        return prices.groupBy("symbol").agg(_between(start, end).alias("return"))
    found = prices.where(F.col("date").between(start, end)).groupBy("symbol").agg(_between(start, end).alias("return"))
    return symbols.select("symbol").distinct().join(found, "symbol", "left")


def ytd_return(prices: DataFrame, as_of=None, symbols: DataFrame | None = None) -> DataFrame:
    """Last close over first close of the year so far, per symbol; null without rows.

    The symbols are those of the prices. Where ``symbols`` lists them, only the prices of the window are read.
    """
    end = resolve_as_of(as_of, prices)
    return _return_between(prices, F.trunc(end, "YEAR"), end, symbols)


def window_return(prices: DataFrame, days: int, as_of=None, symbols: DataFrame | None = None) -> DataFrame:
    """Last over first close in [as_of - days, as_of], per symbol; null without rows. ``symbols`` as for ``ytd_return``."""
    end = resolve_as_of(as_of, prices)
    return _return_between(prices, F.date_sub(end, days), end, symbols)


def returns_by_window(
    metrics: DataFrame,
    prices: DataFrame,
    *,
    benchmark: str,
    windows_days: dict[str, int] | None = None,
    as_of=None,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """One row per (window, symbol) with its return and the benchmark's.

    Windows whose length the metrics already hold take the last known value; other
    lengths and the year to date come from first and last closes. Everything per symbol
    is one grouped aggregation of each input, then turned into rows. Where ``symbols`` lists the symbols, the prices may
    be those of the windows only.
    """
    windows = windows_days or WINDOW_DAYS
    end = resolve_as_of(as_of, prices)
    stored = {w: rolling_column(n) for w, n in windows.items() if rolling_column(n) in metrics.columns}
    inline = {w: n for w, n in windows.items() if w not in stored}

    from_prices = prices.groupBy("symbol").agg(
        _between(F.trunc(end, "YEAR"), end).alias("_ytd"),
        *[_between(F.date_sub(end, n), end).alias(f"_w_{w}") for w, n in inline.items()],
    )
    if symbols is not None:
        from_prices = symbols.select("symbol").distinct().join(from_prices, "symbol", "left")
    wide = from_prices
    if stored:
        last = last_value_at_or_before(metrics, list(stored.values()), end)
        wide = from_prices.join(last, "symbol", "left")

    def entry(window: str, start: Column, value: str) -> Column:
        return F.struct(
            F.lit(window).alias("window"), start.alias("start_date"), F.col(value).alias("return")
        )

    entries = [
        entry(w, F.date_sub(F.col("end_date"), n), stored.get(w, f"_w_{w}"))
        for w, n in windows.items()
    ] + [entry("ytd", F.trunc("end_date", "YEAR"), "_ytd")]
    rows = wide.withColumn("end_date", end).select(
        "symbol", "end_date", F.inline(F.array(*entries))
    )
    # one row per window: the benchmark's line of a frame grouped by symbol
    bench = rows.where(F.col("symbol") == benchmark).select(
        "window", F.col("return").alias("btc_return")
    )
    return rows.join(F.broadcast(bench), "window", "left").select(
        "window",
        "symbol",
        "start_date",
        "end_date",
        "return",
        "btc_return",
        F.when(F.col("symbol") != benchmark, F.col("return") > F.col("btc_return")).alias(
            "beats_btc"
        ),
    )


def window_ordinal(window: Column, windows_days: dict[str, int] | None = None) -> Column:
    """Position in the canonical order; other windows follow in the order they were asked for, then unknown ones."""
    known = list(dict.fromkeys([*WINDOW_ORDER, *(windows_days or {})]))
    place = F.array_position(F.array(*[F.lit(w) for w in known]), window)
    return F.when(place > 0, place).otherwise(len(known) + 1).cast("int")


def window_winners(
    returns: DataFrame, benchmark: str, windows_days: dict[str, int] | None = None
) -> DataFrame:
    """Best non-benchmark symbol of each window. Equal returns: first by symbol."""
    return (
        returns.where((F.col("symbol") != benchmark) & F.col("return").isNotNull())
        .groupBy("window")
        .agg(
            F.min_by(
                F.struct("symbol", "return", "btc_return", "beats_btc"),
                F.struct(-F.col("return"), "symbol"),
            ).alias("w")
        )
        .select(
            window_ordinal(F.col("window"), windows_days).alias("position"),
            "window",
            F.col("w.symbol").alias("winner"),
            F.col("w.return").alias("return"),
            F.col("w.btc_return").alias("btc_return"),
            F.coalesce("w.beats_btc", F.lit(False)).alias("beats_btc"),
        )
    )
