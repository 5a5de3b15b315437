"""Per-asset daily metrics: returns, calendar-window returns, volatility, relative performance.

Rows per asset are bounded by the calendar (a price key is unique per asset and day), so a
window partition holds at most one row per day and no asset can dominate a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.functions.returns import (
    change,
    ratio,
    rolling_volatility,
    series_window,
)
from pricelake.schemas import FACT_KEY, ROLLING_DAYS, VOLATILITY_ROWS

# Default width in days of the narrow look-back frames, and spacing of the bridge rows in
# longer gaps: weekends and holidays need no bridge. Series that usually have longer
# gaps are served better by a larger value; the results do not depend on it.
SLACK_DAYS = 7


# Rows of series that one task sorts: the rows and bridges of some frames are held at once.
TASK_ROWS = 250_000


def rolling_column(days: int) -> str:
    return f"rolling_return_{days}d"


_AT = "_at"
_NEIGHBOURS = ["_prev_close", "_prev_date", "_first_close"]


def spread(series: DataFrame, by: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Whole series dealt to tasks of about ``task_rows`` rows each.

    Adaptive execution merges partitions until they hold many megabytes of narrow rows, and the frames
    hold several times that; so the number of tasks follows the number of rows. Few rows are left as they are.
    """
    tasks = -(-series.count() // task_rows)
    return series.repartition(tasks, *by) if tasks > 1 else series


def _with_neighbours(series: DataFrame, by: list[str]) -> DataFrame:
    """Previous close and date and the first close, all from one pass over the window."""
    order = series_window(by)
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    return series.withColumns(
        {
            "_prev_close": F.lag("close").over(order),
            "_prev_date": F.lag("date").over(order),
            "_first_close": F.first("close").over(so_far),
        }
    )


def rolling_returns(
    series: DataFrame, *, by: list[str], windows: list[int], slack_days: int = SLACK_DAYS
) -> DataFrame:
    """Add ``rolling_return_<n>d`` for every window of n calendar days.

    The base of a window is the first close on or after ``date - n``. A plain RANGE frame
    re-reads up to n rows per row. Here the frame is only ``slack_days`` wide, placed at
    the old end of the window. Where a series has a longer gap than that, bridge rows
    carrying the close that ends the gap are put into it, so a narrow frame that is empty
    can only lie before the first row, whose close is then the base. Exact for any gaps;
    needs a non-null close.
    """
    rows = _with_neighbours(spread(series, by), by)
    return _rolling(rows, by, windows, slack_days).drop(_AT, *_NEIGHBOURS)


def _rolling(rows: DataFrame, by: list[str], windows: list[int], slack_days: int) -> DataFrame:
    """The rows stay sorted by ``_at``, which equals the date once the bridges are gone."""
    day, prev = F.col("date"), F.col("_prev_date")
    gap_start = F.greatest(F.date_add(prev, 1), F.date_sub(day, max(windows)))
    bridged = F.when(
        F.datediff(day, prev) > slack_days,
        F.sequence(day, gap_start, F.expr(f"interval -{int(slack_days)} day")),
    ).otherwise(F.array(day))
    keys = ", ".join(f"`{k}`" for k in by)

    def base(n: int) -> Column:
        near = f"interval '{n - slack_days}' day preceding" if n > slack_days else "current row"
        found = F.expr(
            f"first_value(close) over (partition by {keys} order by `{_AT}` "
            f"range between interval '{int(n)}' day preceding and {near})"
        )
        return F.coalesce(found, F.col("_first_close"))

    bases = {f"_base{n}": base(n) for n in windows}
    return (
        rows.withColumn(_AT, F.explode(bridged))
        .withColumns(bases)
        .where(F.col(_AT) == day)
        .withColumns({rolling_column(n): change(F.col("close"), F.col(f"_base{n}")) for n in windows})
        .drop(*bases)
    )


def with_daily_returns(series: DataFrame, *, by: list[str]) -> DataFrame:
    """Add daily_return and log_return against the previous row."""
    prev = F.lag("close").over(series_window(by))
    return _daily(series.withColumn("_prev_close", prev)).drop("_prev_close")


def _daily(rows: DataFrame) -> DataFrame:
    step = ratio(F.col("close"), F.col("_prev_close"))
    return rows.withColumns({"daily_return": step - F.lit(1.0), "log_return": F.ln(step)})


def with_volatility(series: DataFrame, *, by: list[str], rows: int = VOLATILITY_ROWS) -> DataFrame:
    """Add rolling_vol_<rows>d: deviation over a frame of rows (not days), if all are known.

    A sliding frame is re-read for every row, so the frame is put together from equal
    chunks: count, mean and deviation of the last few rows, looked up at fixed distances
    and merged with the parallel variance formula.
    """
    return _volatility(series, series_window(by), rows)


def _volatility(series: DataFrame, order: WindowSpec, rows: int) -> DataFrame:
    out = f"rolling_vol_{rows}d"
    chunk = next((c for c in (6, 5, 4, 3, 2) if rows % c == 0 and rows > c), None)
    if chunk is None:
        return series.withColumn(out, rolling_volatility(F.col("daily_return"), order, rows))
    frame = order.rowsBetween(-(chunk - 1), 0)
    r = F.col("daily_return")
    part = series.withColumns(
        {
            "_n": F.count(r).over(frame),
            "_mean": F.avg(r).over(frame),
            "_var": F.var_pop(r).over(frame),
        }
    )
    back = range(0, rows, chunk)
    part = part.withColumns(
        {
            f"{c}{k}": F.lag(c, k).over(order) if k else F.col(c)
            for k in back
            for c in ("_n", "_mean", "_var")
        }
    )
    complete = F.lit(True)
    mean = F.lit(0.0)
    for k in back:
        complete = complete & (F.col(f"_n{k}") == chunk)
        mean = mean + F.col(f"_mean{k}") / len(back)
    spread = F.lit(0.0)
    for k in back:
        gap = F.col(f"_mean{k}") - F.col("_all_mean")
        spread = spread + F.col(f"_var{k}") + gap * gap
    return (
        part.withColumn("_all_mean", mean)
        .withColumn(out, F.when(complete, F.sqrt(spread * chunk / (rows - 1))))
        .select(*series.columns, out)
    )


def with_relative_performance(
    series: DataFrame, benchmark: DataFrame, *, by: list[str], out: str = "rel_perf_vs_btc"
) -> DataFrame:
    """Add growth since the asset's first close minus the benchmark's growth.

    ``benchmark`` is (date, close) of one symbol. It is grouped by date, hence at most one
    row per calendar day, which bounds the broadcast. Dates the benchmark lacks give null.
    """
    so_far = series_window(by).rowsBetween(W.unboundedPreceding, 0)
    rows = series.withColumn("_first_close", F.first("close").over(so_far))
    return _relative(rows, benchmark, out).drop("_first_close")


def _relative(rows: DataFrame, benchmark: DataFrame, out: str, bench_first: Column | None = None) -> DataFrame:
    bench = benchmark.groupBy("date").agg(F.max("close").alias("_bench"))
    if bench_first is None:
        bench_first = bench.agg(F.min_by("_bench", "date")).scalar()
    growth = ratio(F.col("close"), F.col("_first_close"))
    return (
        rows.join(F.broadcast(bench), "date", "left")
        .withColumn(out, growth - ratio(F.col("_bench"), bench_first))
        .drop("_bench")
    )


def add_metrics(
    series: DataFrame,
    benchmark: DataFrame,
    *,
    by: list[str],
    windows: list[int] | None = None,
    vol_rows: int = VOLATILITY_ROWS,
    slack_days: int = SLACK_DAYS,
    first_close: str | None = None,
    bench_first: Column | None = None,
) -> DataFrame:
    """All metrics on (by..., date, close): one shuffle by asset serves every frame.

    The calendar windows come first, while the rows are narrow; the volatility frames reuse
    the order they leave behind. A series that does not begin with the asset's first row names a column with the
    first close, and gives the benchmark's.
    """
    out = _rolling(_with_neighbours(spread(series, by), by), by, windows or ROLLING_DAYS, slack_days)
    out = _volatility(_daily(out), series_window(by, _AT), vol_rows)
    if first_close is not None:
        out = out.withColumn("_first_close", F.col(first_close))
    return _relative(out, benchmark, "rel_perf_vs_btc", bench_first).drop(_AT, *_NEIGHBOURS)


def metric_columns(windows: list[int] | None = None, vol_rows: int = VOLATILITY_ROWS) -> list[str]:
    return [
        "daily_return",
        "log_return",
        *[rolling_column(n) for n in (windows or ROLLING_DAYS)],
        f"rolling_vol_{vol_rows}d",
        "rel_perf_vs_btc",
    ]


def fact_daily_metrics(
    fact: DataFrame,
    dates: DataFrame,
    assets: DataFrame,
    *,
    benchmark: str,
    windows: list[int] | None = None,
    vol_rows: int = VOLATILITY_ROWS,
) -> DataFrame:
    """Metrics of every fact row, rebuilt in full."""
    dated = fact.select(*FACT_KEY, "close").join(dates.select("date_id", "date"), "date_id")
    bench = dated.join(
        assets.where(F.col("symbol") == benchmark).select("asset_id"), "asset_id", "left_semi"
    ).select("date", "close")
    out = add_metrics(dated, bench, by=["asset_id"], windows=windows, vol_rows=vol_rows)
    return out.select(*FACT_KEY, *metric_columns(windows, vol_rows))
