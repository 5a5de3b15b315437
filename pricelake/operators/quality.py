"""Data-quality checks. Generic ones return the failing rows; the silver report returns one
line per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date
from pricelake.functions.returns import rolling_return
from pricelake.operators.metrics import rolling_column
from pricelake.schemas import FACT_KEY

# -- generic checks: failing rows ---------------------------------------------------------


def not_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def broken_relationship(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(key).alias(column)).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti").select(
        *child.columns
    )


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose non-null value is not listed."""
    return df.where(~F.col(column).isin(values))


def out_of_range(
    df: DataFrame,
    column: str,
    *,
    low=None,
    high=None,
    inclusive: bool = True,
    where: str | None = None,
) -> DataFrame:
    """Rows (among those ``where`` selects) outside the range; nulls pass."""
    value = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < low if inclusive else value <= low)
    if high is not None:
        bad = bad | (value > high if inclusive else value >= high)
    rows = df.where(F.expr(where)) if where else df
    return rows.where(bad)


def expression_false(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false; unknown passes."""
    test = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~test)


# -- gold checks --------------------------------------------------------------------------


def calendar_gaps(
    assets: DataFrame, dates: DataFrame, fact: DataFrame, *, asset_type: str = "stock"
) -> DataFrame:
    """(asset_id, symbol, date) of trading days without a price, for one asset type.

    The trading days are one array (bounded by the calendar) that each asset's own days
    are taken out of, so neither assets x days nor a second pass over the fact is needed.
    """
    chosen = assets.where(F.col("asset_type") == asset_type).select("asset_id", "symbol")
    trading = (
        dates.where("is_trading_day").agg(F.array_sort(F.collect_set("date_id"))).scalar()
    )
    present = (
        fact.where(F.col("close").isNotNull())
        .join(chosen.select("asset_id"), "asset_id", "left_semi")
        .groupBy("asset_id")
        .agg(F.collect_set("date_id").alias("_have"))
    )
    none = F.array().cast("array<bigint>")
    missing = F.array_except(
        F.coalesce(F.col("_trading"), none), F.coalesce(F.col("_have"), none)
    )
    day = F.col("date_id")
    return (
        chosen.join(present, "asset_id", "left")
        .withColumn("_trading", trading)
        .select("asset_id", "symbol", F.explode(missing).alias("date_id"))
        .select(
            "asset_id",
            "symbol",
            F.make_date(
                F.floor(day / 10000).cast("int"),
                F.floor(day / 100).cast("int") % 100,
                (day % 100).cast("int"),
            ).alias("date"),
        )
    )


def recompute_differences(
    metrics: DataFrame,
    fact: DataFrame,
    dates: DataFrame,
    *,
    days: int = 30,
    tolerance: float = 1e-12,
) -> DataFrame:
    """Stored calendar-window returns that differ from a plain RANGE-frame recomputation."""
    stored = rolling_column(days)
    expected = f"expected_{stored}"
    redone = (
        fact.select(*FACT_KEY, "close")
        .join(dates.select("date_id", "date"), "date_id")
        .select(*FACT_KEY, rolling_return("close", "date", ["asset_id"], days).alias(expected))
    )
    zero = F.lit(0.0)
    gap = F.abs(F.coalesce(stored, zero) - F.coalesce(expected, zero))
    return (
        metrics.select(*FACT_KEY, stored)
        .join(redone, FACT_KEY)
        .where((F.col(stored).isNull() != F.col(expected).isNull()) | (gap > tolerance))
    )


def source_freshness(
    df: DataFrame, *, now: Column, ts: str = "ingested_at", warn_days: int = 2, error_days: int = 5
) -> DataFrame:
    """Age of the newest row against two limits. One row."""
    day_us = 86_400_000_000

    def micros(value: Column) -> Column:
        return F.unix_micros(value.cast("timestamp"))

    age = micros(F.col("_now")) - micros(F.col("_last"))
    return (
        df.agg(F.max(ts).alias("_last"))
        .withColumn("_now", now)
        .select(
            (age / F.lit(day_us)).alias("age_days"),
            F.when(age > error_days * day_us, "error")
            .when(age > warn_days * day_us, "warn")
            .when(age.isNotNull(), "pass")
            .otherwise("error")
            .alias("status"),
        )
    )


# -- silver report ------------------------------------------------------------------------

CHECKS = [
    "silver.unique_symbol_date",
    "silver.close_not_null",
    "silver.close_within_bounds",
    "silver.freshness",
]


def stale_symbols(prices: DataFrame, *, as_of, max_lag_days: int) -> DataFrame:
    """(symbol, max_date) of symbols whose newest price is older than the allowed lag."""
    return (
        prices.groupBy("symbol")
        .agg(F.max("date").alias("max_date"))
        .where(F.datediff(as_date(as_of), F.col("max_date")) > max_lag_days)
    )


def silver_report(
    prices: DataFrame, *, as_of, low: float, high: float, max_lag_days: int
) -> DataFrame:
    """The four gate checks as (test_name, passed, row_count, severity, details).

    One scan: counted per key, rolled up per symbol, then overall. ``row_count`` is the
    number of violations. The stale symbols themselves are rows of ``stale_symbols``.
    """
    close = F.col("close")
    per_key = prices.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(close.isNull()).alias("nulls"),
        F.count_if((close < low) | (close > high)).alias("outside"),
    )
    per_symbol = per_key.groupBy("symbol").agg(
        F.max("date").alias("max_date"),
        F.count_if(F.col("n") > 1).alias("dupes"),
        F.sum("nulls").alias("nulls"),
        F.sum("outside").alias("outside"),
    )
    stale = F.when(
        F.datediff(as_date(as_of), F.col("max_date")) > max_lag_days, F.col("symbol")
    )
    none = F.lit(0).cast("long")
    totals = per_symbol.agg(
        F.coalesce(F.sum("dupes"), none).alias("dupes"),
        F.coalesce(F.sum("nulls"), none).alias("nulls"),
        F.coalesce(F.sum("outside"), none).alias("outside"),
        F.count(stale).alias("stale"),
    )

    def line(name: str, count: Column, severity: Column, details: Column) -> Column:
        return F.struct(
            F.lit(name).alias("test_name"),
            (count == 0).alias("passed"),
            count.cast("long").alias("row_count"),
            severity.alias("severity"),
            F.to_json(details).alias("details"),
        )

    error = F.lit("error")
    n_stale = F.col("stale")
    bounds = F.array(F.lit(float(low)), F.lit(float(high)))
    return totals.select(
        F.inline(
            F.array(
                line(CHECKS[0], F.col("dupes"), error, F.struct(F.col("dupes").alias("duplicate_keys"))),
                line(CHECKS[1], F.col("nulls"), error, F.struct(F.col("nulls").alias("null_close_rows"))),
                line(
                    CHECKS[2],
                    F.col("outside"),
                    error,
                    F.struct(F.col("outside").alias("out_of_range_rows"), bounds.alias("bounds")),
                ),
                line(
                    CHECKS[3],
                    n_stale,
                    F.when(n_stale > 0, "error").otherwise("info"),
                    F.struct(n_stale.alias("stale_count")),
                ),
            )
        )
    )


class QualityGateError(RuntimeError):
    """Raised when a check of severity ``error`` failed."""


def record_report(report: DataFrame, path: str, *, run_id: str | None = None) -> None:
    """Append the report's lines to the quality history."""
    (
        report.select(
            F.lit(run_id).cast("string").alias("run_id"),
            "test_name",
            F.current_timestamp().alias("run_ts"),
            "passed",
            "row_count",
            "severity",
            "details",
        )
        .write.mode("append")
        .parquet(path)
    )


def enforce(report: DataFrame) -> None:
    """Raise if an error-severity check failed (the report has one row per check)."""
    failed = report.where(~F.col("passed") & (F.col("severity") == "error")).select("test_name")
    names = sorted(r["test_name"] for r in failed.collect())
    if names:
        raise QualityGateError(f"quality checks failed: {', '.join(names)}")


def quality_rollup(results: DataFrame) -> DataFrame:
    """Per test: runs, failures and summed integer details."""

    def total(key: str) -> Column:
        # only JSON integers count, as text they have neither quotes nor a fraction
        raw = F.get_json_object("details", f"$.{key}")
        return F.coalesce(F.sum(raw.try_cast("bigint")), F.lit(0).cast("long")).alias(key)

    return results.groupBy("test_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(~F.col("passed")).alias("failures"),
        total("duplicate_keys"),
        total("null_close_rows"),
        total("out_of_range_rows"),
    )


def stale_by_test(results: DataFrame, stale: DataFrame | None = None) -> DataFrame:
    """(test_name, symbol) of the symbols that runs found stale, one row each.

    ``stale`` is the table of stale symbols that each run of the lake appends to; a history may also hold lists in its details.
    """
    listed = F.from_json(F.get_json_object("details", "$.stale_symbols"), "array<string>")
    found = results.select("test_name", F.explode(listed).alias("symbol"))
    if stale is not None:
        found = found.unionByName(stale.select(F.lit(CHECKS[3]).alias("test_name"), "symbol"))
    return found.distinct()
