"""Return and volatility expressions over an ordered price series."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.schemas import TRADING_DAYS_PER_YEAR


def _nonzero(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def ratio(close: Column, base: Column) -> Column:
    """close / base, null when the base is zero or missing."""
    return close / _nonzero(base)


def change(close: Column, base: Column) -> Column:
    """Relative change from base to close."""
    return ratio(close, base) - F.lit(1.0)


def series_window(by: list[str], date: str = "date") -> WindowSpec:
    """The one ordering every series operator uses, so Spark sorts once."""
    return W.partitionBy(*by).orderBy(date)


def daily_return(close: Column, window: WindowSpec) -> Column:
    return change(close, F.lag(close).over(window))


def log_return(close: Column, window: WindowSpec) -> Column:
    """ln(close / previous close); null for non-positive ratios."""
    return F.ln(ratio(close, F.lag(close).over(window)))


def rolling_return(close: str, date: str, by: list[str], days: int) -> Column:
    """Return against the first close inside [date - days, date] (calendar days).

    A plain RANGE frame: Spark re-reads the frame for every row. Use
    ``operators.metrics.rolling_returns`` for long windows over long series.
    """
    keys = ", ".join(f"`{k}`" for k in by)
    anchor = F.expr(
        f"first_value(`{close}`) over (partition by {keys} order by `{date}` "
        f"range between interval '{int(days)}' day preceding and current row)"
    )
    return change(F.col(close), anchor)


def rolling_volatility(returns: Column, window: WindowSpec, rows: int) -> Column:
    """Sample standard deviation over the last ``rows`` rows, only when all are known."""
    frame = window.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(returns).over(frame) >= rows, F.stddev_samp(returns).over(frame))


def annualised_percent(sigma: Column) -> Column:
    """Daily standard deviation as yearly percent."""
    return sigma * F.lit(float(TRADING_DAYS_PER_YEAR) ** 0.5) * F.lit(100.0)
