"""Lump-sum and periodic investing, for all symbols at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date, month_index, monthly_target, resolve_as_of
from pricelake.operators.asof import latest_price


def _outcome(value: Column, invested: Column) -> list[Column]:
    return [
        value.alias("current_value_usd"),
        (value - invested).alias("pnl_usd"),
        ((value - invested) / invested).alias("total_return"),
    ]


def _units(amount: Column, price: Column) -> Column:
    """Units bought; null at a zero price, which makes the symbol's outcome unknown."""
    return amount / F.nullif(price, F.lit(0.0))


def lump_sum(prices: DataFrame, *, principal_usd: float, start, end) -> DataFrame:
    """Buy at the first close on or after ``start``, value at the last one up to ``end``.

    Symbols without either price are left out. One grouped aggregation.
    """
    day = F.col("date")
    entry_day = F.when(day >= as_date(start), day)
    exit_day = F.when(day <= as_date(end), day)
    units = _units(F.col("principal_usd"), F.col("start_price"))
    return (
        prices.groupBy("symbol")
        .agg(
            F.min(entry_day).alias("start_date"),
            F.min_by("close", entry_day).alias("start_price"),
            F.max(exit_day).alias("end_date"),
            F.max_by("close", exit_day).alias("end_price"),
        )
        .where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
        .withColumn("principal_usd", F.lit(float(principal_usd)))
        .withColumn("units", units)
        .select(
            "symbol",
            "principal_usd",
            "units",
            "start_date",
            "end_date",
            "start_price",
            "end_price",
            *_outcome(F.col("units") * F.col("end_price"), F.col("principal_usd")),
        )
    )


def lump_sum_one_year(prices: DataFrame, *, principal_usd: float = 1000.0, as_of=None) -> DataFrame:
    """Invested on the same day one year before ``as_of`` (Feb 29 becomes Feb 28)."""
    end = resolve_as_of(as_of, prices)
    return lump_sum(prices, principal_usd=principal_usd, start=F.add_months(end, -12), end=end)


def buy_schedule(symbols: DataFrame, *, months: int, start, buy_day: int = 1) -> DataFrame:
    """(symbol, buy_no, target) for every month; the first target may precede ``start``."""
    return symbols.select(
        "symbol", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("buy_no")
    ).withColumn("target", monthly_target(as_date(start), F.col("buy_no"), buy_day))


def dca_buys(
    prices: DataFrame, *, monthly_amount_usd: float, months: int, start, buy_day: int = 1
) -> DataFrame:
    """(symbol, buy_no, target, fill_date, price, units): each target filled forward.

    A fill may be later than any reporting date; targets after the last price are not
    filled. The targets are one per month, so a price's month tells which targets it can
    fill: the first price of each target month is kept by a partial aggregation, and an
    empty month is served by the next kept one. No range join is needed.
    """
    begin = as_date(start)
    day = F.col("date")
    before_buy_day = F.when(F.dayofmonth(day) < buy_day, 1).otherwise(0)
    slot = month_index(day) - month_index(begin) - before_buy_day
    first_of_slot = (
        prices.withColumn("slot", F.least(slot, F.lit(months - 1)))
        .where(F.col("slot") >= 0)
        .groupBy("symbol", "slot")
        .agg(F.min("date").alias("fill_date"), F.min_by("close", "date").alias("price"))
    )
    # at most one row per month of the schedule in each partition of this window
    earlier = F.coalesce(F.lag("slot").over(W.partitionBy("symbol").orderBy("slot")), F.lit(-1))
    return (
        first_of_slot.withColumn("_earlier", earlier)
        .withColumn("buy_no", F.explode(F.sequence(F.col("_earlier") + 1, F.col("slot"))))
        .withColumn("target", monthly_target(begin, F.col("buy_no"), buy_day))
        .withColumn("units", _units(F.lit(float(monthly_amount_usd)), F.col("price")))
        .select("symbol", "buy_no", "target", "fill_date", "price", "units")
    )


def dca(
    prices: DataFrame,
    *,
    monthly_amount_usd: float,
    months: int,
    start,
    as_of=None,
    buy_day: int = 1,
) -> DataFrame:
    """Totals of periodic buying per symbol, valued at the last close up to ``as_of``."""
    end = resolve_as_of(as_of, prices)
    buys = dca_buys(
        prices, monthly_amount_usd=monthly_amount_usd, months=months, start=start, buy_day=buy_day
    )
    totals = buys.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("months"),
        F.when(F.count("units") == F.count(F.lit(1)), F.sum("units")).alias("total_units"),
    )
    last = latest_price(prices, end).select("symbol", F.col("close").alias("final_price_usd"))
    amount = F.lit(float(monthly_amount_usd))
    return (
        totals.join(last, "symbol")
        .withColumn("total_invested_usd", amount * F.col("months"))
        .select(
            "symbol",
            amount.alias("monthly_amount_usd"),
            "months",
            "total_invested_usd",
            "total_units",
            "final_price_usd",
            *_outcome(F.col("total_units") * F.col("final_price_usd"), F.col("total_invested_usd")),
        )
    )


_STRATEGY = [
    "strategy",
    "symbol",
    "principal_usd",
    "n_buys",
    "units",
    "current_value_usd",
    "pnl_usd",
    "total_return",
]


def dca_vs_lump_sum(
    prices: DataFrame,
    *,
    monthly_amount_usd: float = 100.0,
    months: int = 12,
    buy_day: int = 1,
    as_of=None,
    symbol: str | None = None,
) -> DataFrame:
    """Both strategies over the last 365 days with the same nominal principal.

    For one symbol, or for all of them when none is named.
    """
    end = resolve_as_of(as_of, prices)
    start = F.date_sub(end, 365)
    chosen = prices if symbol is None else prices.where(F.col("symbol") == symbol)
    periodic = dca(
        chosen,
        monthly_amount_usd=monthly_amount_usd,
        months=months,
        start=start,
        as_of=end,
        buy_day=buy_day,
    ).select(
        F.lit("dca").alias("strategy"),
        "symbol",
        F.col("total_invested_usd").alias("principal_usd"),
        F.col("months").alias("n_buys"),
        F.col("total_units").alias("units"),
        "current_value_usd",
        "pnl_usd",
        "total_return",
    )
    at_once = lump_sum(
        chosen, principal_usd=monthly_amount_usd * months, start=start, end=end
    ).select(
        F.lit("lump_sum").alias("strategy"),
        "symbol",
        "principal_usd",
        F.lit(1).cast("long").alias("n_buys"),
        "units",
        "current_value_usd",
        "pnl_usd",
        "total_return",
    )
    return periodic.select(*_STRATEGY).unionByName(at_once.select(*_STRATEGY))


def dca_path(
    prices: DataFrame,
    *,
    monthly_amount_usd: float = 100.0,
    months: int = 12,
    buy_day: int = 1,
    as_of=None,
    symbol: str | None = None,
) -> DataFrame:
    """Daily value of both strategies from the first buy to ``as_of``.

    Units and cost so far are running sums over the days of a symbol (bounded by the
    calendar) of what was bought that day.
    """
    end = resolve_as_of(as_of, prices)
    start = F.date_sub(end, 365)
    chosen = prices if symbol is None else prices.where(F.col("symbol") == symbol)
    amount = F.lit(float(monthly_amount_usd))
    buys = dca_buys(
        chosen, monthly_amount_usd=monthly_amount_usd, months=months, start=start, buy_day=buy_day
    )
    bought = buys.groupBy("symbol", F.col("fill_date").alias("date")).agg(
        F.sum("units").alias("units"), (amount * F.count(F.lit(1))).alias("cost")
    )
    lump = lump_sum(
        chosen, principal_usd=monthly_amount_usd * months, start=start, end=end
    ).select("symbol", F.col("units").alias("lump_units"))
    begin = buys.groupBy("symbol").agg(F.min("fill_date").alias("first_buy"))
    so_far = W.partitionBy("symbol").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return (
        chosen.select("symbol", "date", "close")
        .where(F.col("date") <= end)
        .join(begin, "symbol")
        .where(F.col("date") >= F.col("first_buy"))
        .join(lump, "symbol")
        .join(bought, ["symbol", "date"], "left")
        .select(
            "symbol",
            "date",
            (F.sum("units").over(so_far) * F.col("close")).alias("dca_value"),
            F.sum("cost").over(so_far).alias("dca_invested"),
            (F.col("lump_units") * F.col("close")).alias("lump_value"),
        )
    )
