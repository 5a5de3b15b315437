"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.functions.dates import date_id, sunday_zero_dow
from pricelake.operators.numbering import number_rows
from pricelake.schemas import CLOSE_ONLY_SOURCE, DEFAULT_BASE_CCY, PRICE_COMPLETENESS


def dim_asset_type(silver: DataFrame) -> DataFrame:
    """(asset_type_id, name). The type is an enumeration of four, so one task numbers it."""
    names = silver.select(F.col("asset_type").alias("name")).distinct()
    return names.select(
        F.row_number().over(W.orderBy("name")).cast("long").alias("asset_type_id"), "name"
    )


def dim_asset(
    silver: DataFrame,
    types: DataFrame,
    catalog: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per (symbol, asset_type, source), described by the catalog.

    Without ``existing`` ids are row numbers by symbol. With it, known symbols keep their
    id, also when silver no longer holds them, and new ones continue after the highest: no
    id is ever given twice, so facts that hold old ids stay valid.
    """
    seen = silver.select("symbol", "asset_type", "source").distinct()
    ohlcv, close_only = PRICE_COMPLETENESS
    key = ["symbol", "asset_type", "source"]
    typed = seen.join(types.withColumnRenamed("name", "asset_type"), "asset_type").select(
        *key, "asset_type_id"
    )
    order = [F.col(c) for c in key]
    if existing is None:
        numbered = number_rows(typed, order, "asset_id")
    else:
        old = existing.select("asset_id", *key, F.col("asset_type_id").alias("_old_type"))
        current = types.withColumnRenamed("name", "asset_type")
        ids = old.join(current, "asset_type", "left").select(
            "asset_id", *key, F.coalesce("asset_type_id", "_old_type").alias("asset_type_id")
        )
        after = F.coalesce(existing.agg(F.max("asset_id")).scalar(), F.lit(0)) + 1
        fresh = number_rows(typed.join(ids.select(*key), key, "left_anti"), order, "asset_id", start=after)
        numbered = ids.select(*fresh.columns).unionByName(fresh)
    described = catalog.select("symbol", "name", "base_ccy", "price_completeness")
    return numbered.join(described, "symbol", "left").select(
        "asset_id",
        "symbol",
        F.coalesce("name", "symbol").alias("name"),
        "asset_type_id",
        "asset_type",
        "source",
        F.coalesce(
            "price_completeness",
            F.when(F.col("source") == CLOSE_ONLY_SOURCE, close_only).otherwise(ohlcv),
        ).alias("price_completeness"),
        F.coalesce("base_ccy", F.lit(DEFAULT_BASE_CCY)).alias("base_ccy"),
    )


def dim_date(silver: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """One row per observed date; trading day from the calendar, else Monday to Friday."""
    d = F.col("date")
    days = silver.select("date").distinct()
    flagged = (
        days.withColumn("listed", F.lit(None).cast("boolean"))
        if calendar is None
        else days.join(calendar.select("date", F.col("is_trading_day").alias("listed")), "date", "left")
    )
    return flagged.select(
        date_id(d).alias("date_id"),
        "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        sunday_zero_dow(d).alias("dow"),
        F.coalesce("listed", sunday_zero_dow(d).between(1, 5)).alias("is_trading_day"),
    )
