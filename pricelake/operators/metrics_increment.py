"""Metrics of a stored fact, recomputed where a change of prices reaches.

A changed close reaches the next row (daily return), the rows of the longest calendar window after it, the next
``vol_rows`` rows (deviation), and, if it is the asset's first, all rows (relative performance). A change
of the benchmark reaches all assets on its days, one of its first close all rows. An index with a line for each asset and month
(rows, first date and close) tells which months that is, and from which month on prices have to be read
so that the rows come out as in a full rebuild. Only these months of the fact and of the metrics are read, and only the changed months
of the metrics are rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.dates import date_of
from pricelake.operators.facts import FACT_MONTH
from pricelake.operators.metrics import SLACK_DAYS, add_metrics, metric_columns
from pricelake.schemas import FACT_KEY, ROLLING_DAYS, VOLATILITY_ROWS
from pricelake.sources.versioned import MonthlyTable, Staged

INDEX = T.StructType(
    [
        T.StructField("asset_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("first_close", T.DoubleType()),
    ]
)
METRICS = T.StructType([T.StructField(c, T.LongType(), False) for c in FACT_KEY] + [T.StructField(c, T.DoubleType()) for c in metric_columns()])
INDEX_MONTH = "date_format(first_date, 'yyyy-MM')"
_LAST = "date'9999-12-01'"


def metrics_table(spark, root: str) -> MonthlyTable:
    return MonthlyTable(spark, root, METRICS, FACT_MONTH)


def index_table(spark, root: str) -> MonthlyTable:
    return MonthlyTable(spark, root, INDEX, INDEX_MONTH)


def month_index(fact: DataFrame) -> DataFrame:
    """One row for each asset and month of the fact: rows, first date and its close."""
    dated = fact.select("asset_id", "close", date_of(F.col("date_id")).alias("date"))
    return dated.groupBy("asset_id", F.trunc("date", "MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.min_by("close", "date").alias("first_close")
    ).drop("_month")


def changed_days(fresh: DataFrame) -> DataFrame:
    """First and last changed day of each asset (asset_id, lo, hi)."""
    return fresh.groupBy("asset_id").agg(date_of(F.min("date_id")).alias("lo"), date_of(F.max("date_id")).alias("hi"))


def _flags(changes: DataFrame, index: DataFrame, benchmark: tuple | None, windows: list[int], vol_rows: int) -> DataFrame:
    """The index's months that a change reaches (``reached``) or that are read for it."""
    whole = W.partitionBy("asset_id")
    rows = index.join(changes, "asset_id", "left").withColumns({"_m": F.trunc("first_date", "MM"), "_first": F.min("first_date").over(whole)})
    if benchmark is not None:
        lo, hi = (F.lit(d).cast("date") for d in benchmark)
        rows = rows.withColumns({"lo": F.least("lo", lo), "hi": F.greatest("hi", hi)})
    rows = rows.where(F.col("lo").isNotNull())
    # a changed first close reaches every row
    rows = rows.withColumn("hi", F.when(F.col("lo") <= F.col("_first"), F.expr(_LAST)).otherwise(F.col("hi")))
    rows = rows.withColumns({"_from": F.trunc("lo", "MM"), "_to": F.trunc("hi", "MM")})
    upward = whole.orderBy("_m").rowsBetween(W.unboundedPreceding, -1)
    downward = whole.orderBy(F.desc("_m")).rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    rows = rows.withColumns({
        "_after": F.coalesce(F.sum(F.when(F.col("_m") > F.col("_to"), F.col("n"))).over(upward), none),
        "_before": F.coalesce(F.sum(F.when(F.col("_m") < F.col("_from"), F.col("n"))).over(downward), none),
    })
    longest = max(windows)
    reached = (F.col("_m") >= F.col("_from")) & (
        (F.col("_m") <= F.trunc(F.date_add("hi", longest), "MM")) | (F.col("_after") <= vol_rows) | (F.col("_to") >= F.expr(_LAST))
    )
    needed = (F.col("_m") < F.col("_from")) & (
        (F.col("_m") >= F.trunc(F.date_sub("_from", longest), "MM")) | (F.col("_before") <= vol_rows)
    )
    return rows.where(reached | needed).select("asset_id", "_m", reached.alias("reached"), "_first", "first_date", "first_close")


@dataclass
class Increment:
    """What a change made of the metrics."""

    staged: Staged
    spans: DataFrame
    read_months: set[str]


def _name(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def stage_metrics(
    metrics: MonthlyTable,
    fact: Staged,
    index: Staged,
    fresh: DataFrame,
    *,
    benchmark_id: int | None,
    spans_table,
    windows: list[int] | None = None,
    vol_rows: int = VOLATILITY_ROWS,
    slack_days: int = SLACK_DAYS,
) -> Increment:
    """Write the months of the metrics that the fresh fact rows reach. ``spans_table`` keeps one row for each asset and month concerned."""
    windows = windows or ROLLING_DAYS
    changes = changed_days(fresh)
    months = index.read()
    moved = bench_first = None
    if benchmark_id is not None:
        own = changes.where(F.col("asset_id") == benchmark_id).first()
        first = months.where(F.col("asset_id") == benchmark_id).agg(F.min("first_date").alias("d"), F.min_by("first_close", "first_date").alias("c")).first()
        bench_first = first["c"]
        if own is not None:
            # a changed first close of the benchmark reaches every row of every asset
            moved = ("0001-01-01", "9999-12-01") if own["lo"] <= first["d"] else (own["lo"], own["hi"])
    flags = spans_table.replace(_flags(changes, months, moved, windows, vol_rows))
    found = flags.groupBy(_name(F.col("_m")).alias("m")).agg(F.max("reached").alias("reached")).collect()  # calendar months
    read_months = {r["m"] for r in found}
    reached_months = {r["m"] for r in found if r["reached"]}
    reached = F.when(F.col("reached"), F.col("_m"))
    spans = flags.groupBy("asset_id").agg(
        F.min("_m").alias("_read"), F.min(reached).alias("_from"), F.max(reached).alias("_to")
    ).where(F.col("_from").isNotNull())
    firsts = months.groupBy("asset_id").agg(F.min_by("first_close", "first_date").alias("_start"))
    prices = fact.read(read_months).select(*FACT_KEY, "close", date_of(F.col("date_id")).alias("date"))
    month = F.trunc("date", "MM")
    series = prices.join(spans, "asset_id").where(month.between(F.col("_read"), F.col("_to"))).join(firsts, "asset_id")
    bench = prices.where(F.col("asset_id") == F.lit(benchmark_id).cast("long")).select("date", "close")
    redone = add_metrics(
        series, bench, by=["asset_id"], windows=windows, vol_rows=vol_rows, slack_days=slack_days,
        first_close="_start", bench_first=F.lit(bench_first).cast("double"),
    ).where(F.trunc("date", "MM") >= F.col("_from"))
    columns = [*FACT_KEY, *metric_columns(windows, vol_rows)]
    kept = metrics.read(reached_months).withColumn("_m", F.trunc(date_of(F.col("date_id")), "MM")).join(spans, "asset_id", "left")
    kept = kept.where(F.col("_from").isNull() | ~F.col("_m").between(F.col("_from"), F.col("_to")))
    staged = metrics.stage(kept.select(*columns).unionByName(redone.select(*columns)), reached_months)
    return Increment(staged, spans, read_months)
