"""Daily-bar payload pages (one JSON document per page) to bronze rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.dates import millis_to_date
from pricelake.schemas import BAR_PAGE, BRONZE


def read_bar_pages(spark: SparkSession, path: str) -> DataFrame:
    """All landed pages under ``path``; a chain of pages is simply several files."""
    return spark.read.schema(BAR_PAGE).option("multiLine", True).option("mode", "FAILFAST").json(path)


def parse_bar_pages(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Pages held as JSON text in a column; the other columns are kept."""
    page = F.from_json(payload, BAR_PAGE, {"mode": "FAILFAST"})
    rest = [c for c in landed.columns if c != payload]
    return landed.select(*rest, page.alias("page")).select(*rest, "page.*")


def required(value: Column, kind: str, message: str) -> Column:
    """The value, or a failed job when it is missing."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast(kind))


def normalize_bars(
    pages: DataFrame, *, run_id: str, ingested_at: dt.datetime | Column, source: str = "massive"
) -> DataFrame:
    """One bronze row per element of ``results``; empty or missing results give no rows.

    ``pages`` carries ``symbol`` and ``asset_type`` beside the page's own fields.
    """
    bar = pages.select("symbol", "asset_type", F.explode("results").alias("bar"))

    def must(field: str, kind: str = "double") -> Column:
        return required(F.col(f"bar.{field}"), kind, f"bar without required field {field}")

    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return bar.select(
        F.lit(source).alias("source"),
        "asset_type",
        "symbol",
        millis_to_date(must("t", "bigint")).alias("date"),
        must("o").alias("open"),
        must("h").alias("high"),
        must("l").alias("low"),
        must("c").alias("close"),
        must("v").alias("volume"),
        F.col("bar.vw").alias("vwap"),
        F.col("bar.n").alias("trade_count"),
        stamp.cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("run_id"),
    ).select(*BRONZE.fieldNames())
