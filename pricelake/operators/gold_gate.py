"""The gold checks as a gate: counted violations of staged tables, before they are published.

All checks of single rows of a table are one aggregation over one scan; keys are counted by their columns, and
references are left anti joins. Of the facts only the months that a run rewrites are checked: the
others were when they were written. What is new to the gate is a line for each check in the shape of the silver report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import date_of
from pricelake.operators.metrics import rolling_column
from pricelake.operators.quality import broken_relationship, calendar_gaps, not_unique, recompute_differences
from pricelake.schemas import DEFAULT_BASE_CCY, FACT_KEY, PRICE_COMPLETENESS, SOURCES


def _listed(column: str, values: list[str]) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in values)})"


# What the gold tables accept. A row fails where the expression is true; unknown passes.
ROW_RULES: dict[str, dict[str, str]] = {
    "dim_asset_type": {"asset_type_id.not_null": "asset_type_id IS NULL", "name.not_null": "name IS NULL"},
    "dim_asset": {
        **{f"{c}.not_null": f"{c} IS NULL" for c in ("asset_id", "symbol", "asset_type_id", "source", "base_ccy")},
        "price_completeness.accepted": _listed("price_completeness", PRICE_COMPLETENESS),
        "source.accepted": _listed("source", SOURCES),
        "base_ccy.accepted": _listed("base_ccy", [DEFAULT_BASE_CCY]),
    },
    "dim_date": {f"{c}.not_null": f"{c} IS NULL" for c in ("date_id", "date", "is_trading_day")},
    "fact_daily_price": {
        **{f"{c}.not_null": f"{c} IS NULL" for c in ("asset_id", "date_id", "close", "ingested_at")},
        "close.range": "close <= 0 OR close >= 1000000",
        "volume.range": "volume < 0",
        "close_within_low_high": "NOT (low <= close AND close <= high)",
        "open_within_low_high": "NOT (low <= open AND open <= high)",
    },
    "fact_daily_metrics": {
        **{f"{c}.not_null": f"{c} IS NULL" for c in ("asset_id", "date_id")},
        "daily_return.range": "daily_return <= -1 OR daily_return >= 1",
        "rolling_vol_30d.range": "rolling_vol_30d < 0",
    },
}
KEYS: dict[str, list[list[str]]] = {
    "dim_asset_type": [["asset_type_id"], ["name"]],
    "dim_asset": [["asset_id"], ["symbol"]],
    "dim_date": [["date_id"], ["date"]],
    "fact_daily_price": [FACT_KEY],
    "fact_daily_metrics": [FACT_KEY],
}
REFERENCES = [
    ("dim_asset", "asset_type_id", "dim_asset_type"),
    ("fact_daily_price", "asset_id", "dim_asset"),
    ("fact_daily_price", "date_id", "dim_date"),
    ("fact_daily_metrics", "asset_id", "dim_asset"),
    ("fact_daily_metrics", "date_id", "dim_date"),
]
GAPS = "no_calendar_gaps_stock"
RECOMPUTED = f"{rolling_column(30)}_calendar_window"


def row_violations(table: str, rows: DataFrame) -> DataFrame:
    """(test_name, row_count) of all single-row checks of a table, from one scan."""
    rules = list(ROW_RULES[table].items())
    counts = rows.agg(*(F.count_if(F.expr(bad)).alias(f"_{i}") for i, (_, bad) in enumerate(rules)))
    lines = F.array(*(F.struct(F.lit(f"{table}.{name}").alias("test_name"), F.col(f"_{i}").alias("row_count")) for i, (name, _) in enumerate(rules)))
    return counts.select(F.inline(lines))


def _line(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("test_name"), "row_count")


def gaps(assets: DataFrame, dates: DataFrame, prices: DataFrame, known: DataFrame | None, months: set[str] | None) -> DataFrame:
    """Trading days without a price of stock assets.

    ``prices`` has the rows of ``months`` only (None: all). Known assets are asked for the days of these months; all rows of new ones
    are among the prices, so they are asked for every trading day.
    """
    if known is None or months is None:
        return calendar_gaps(assets, dates, prices)
    old = known.select("asset_id").distinct()
    in_months = dates.where(F.date_format("date", "yyyy-MM").isin(sorted(months)))
    return calendar_gaps(assets.join(old, "asset_id", "left_semi"), in_months, prices).unionByName(
        calendar_gaps(assets.join(old, "asset_id", "left_anti"), dates, prices)
    )


def gold_report(
    tables: dict[str, DataFrame],
    *,
    known_assets: DataFrame | None = None,
    months: set[str] | None = None,
    halo: DataFrame | None = None,
    severity: dict[str, str] | None = None,
) -> DataFrame:
    """All gold checks as (test_name, passed, row_count, severity, details).

    ``tables`` holds the gold tables that are to be published, facts with the rows of ``months`` only (None: whole tables). ``halo`` are prices that
    reach at least 30 days before these months, for the recomputed returns. ``severity`` (error by default) goes by check name.
    """
    lines = [row_violations(t, rows) for t, rows in tables.items()]
    lines += [_line(f"{t}.{'_'.join(key)}.unique", not_unique(rows, key)) for t, rows in tables.items() for key in KEYS[t]]
    for child, column, parent in REFERENCES:
        if child in tables and parent in tables:
            orphans = broken_relationship(tables[child].select(column), column, tables[parent], KEYS[parent][0][0])
            lines.append(_line(f"{child}.{column}.reference", orphans))
    prices = tables.get("fact_daily_price")
    if prices is not None:
        lines.append(_line(GAPS, gaps(tables["dim_asset"], tables["dim_date"], prices, known_assets, months)))
    if prices is not None and "fact_daily_metrics" in tables:
        fact = prices if halo is None else halo
        dated = fact.select("date_id", date_of(F.col("date_id")).alias("date")).distinct()
        lines.append(_line(RECOMPUTED, recompute_differences(tables["fact_daily_metrics"], fact, dated)))
    counted = reduce(DataFrame.unionByName, lines)
    chosen = F.lit("error")
    for name, level in (severity or {}).items():
        chosen = F.when(F.col("test_name") == name, level).otherwise(chosen)
    return counted.select(
        "test_name",
        (F.col("row_count") == 0).alias("passed"),
        F.col("row_count").cast("long").alias("row_count"),
        chosen.alias("severity"),
        F.to_json(F.struct(F.col("row_count").alias("failing_rows"))).alias("details"),
    )
