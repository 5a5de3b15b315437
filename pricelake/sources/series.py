"""Parallel-array payloads ([ts, price], [ts, volume]) to close-only rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.dates import as_date, millis_to_date
from pricelake.schemas import BRONZE, CLOSE_ONLY_SOURCE, SERIES_PAGE


def read_series_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents, keyed by the file they came from (``page_id``)."""
    return (
        spark.read.schema(SERIES_PAGE)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col("_metadata.file_path").alias("page_id"), *SERIES_PAGE.fieldNames())
    )


def parse_series_pages(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents held as JSON text in a column; the other columns are kept."""
    page = F.from_json(payload, SERIES_PAGE, {"mode": "FAILFAST"})
    rest = [c for c in landed.columns if c != payload]
    return landed.select(*rest, page.alias("page")).select(*rest, "page.*")


def _checked_pairs(name: str) -> Column:
    bad = F.raise_error(F.lit(f"{name}: expected [timestamp, value] pairs")).cast(
        "array<array<double>>"
    )
    pairs = F.coalesce(F.col(name), F.array().cast("array<array<double>>"))
    return F.when(F.forall(pairs, lambda p: F.size(p) == 2), pairs).otherwise(bad)


def normalize_series(
    pages: DataFrame,
    *,
    start,
    end,
    run_id: str,
    ingested_at: dt.datetime | Column,
    source: str = CLOSE_ONLY_SOURCE,
) -> DataFrame:
    """Match prices and volumes of a page on the timestamp; a later pair overwrites.

    Instead of joining two exploded arrays, both are exploded as one event list and
    grouped once by (page, timestamp). Ticks without a price are dropped. ``ts_ms`` is
    kept for the day collapse. ``pages`` carries ``page_id``, ``symbol``, ``asset_type``.
    """
    number = "double"

    def events(name: str, is_price: bool) -> Column:
        def one(pair: Column, pos: Column) -> Column:
            none = F.lit(None)
            return F.struct(
                pair[0].cast("bigint").alias("ts_ms"),
                (pos if is_price else none).cast("int").alias("price_pos"),
                (none if is_price else pos).cast("int").alias("volume_pos"),
                pair[1].cast(number).alias("value"),
            )

        return F.transform(_checked_pairs(name), one)

    # market caps are checked but not kept; a filter on them would parse every page twice
    no_caps = F.filter(events("market_caps", False), lambda e: F.lit(False))
    ticks = (
        pages.select(
            "page_id",
            "symbol",
            "asset_type",
            F.explode(
                F.concat(events("prices", True), events("total_volumes", False), no_caps)
            ).alias("e"),
        )
        .groupBy("page_id", "symbol", "asset_type", F.col("e.ts_ms").alias("ts_ms"))
        .agg(
            F.max_by("e.value", "e.price_pos").alias("close"),
            F.max_by("e.value", "e.volume_pos").alias("volume"),
        )
        .where(F.col("close").isNotNull())
        .withColumn("date", millis_to_date(F.col("ts_ms")))
        .where(F.col("date").between(as_date(start), as_date(end)))
    )
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    nothing = {
        f.name: F.lit(None).cast(f.dataType)
        for f in BRONZE.fields
        if f.name in ("open", "high", "low", "vwap", "trade_count")
    }
    return ticks.withColumns(
        {
            **nothing,
            "source": F.lit(source),
            "ingested_at": stamp.cast("timestamp"),
            "run_id": F.lit(run_id),
        }
    ).select(*BRONZE.fieldNames(), "ts_ms", "page_id")


def collapse_to_day(ticks: DataFrame, order_by: list[str]) -> DataFrame:
    """First tick of each (symbol, date), which is what a strict newer-wins upsert keeps
    of a batch that shares one ingestion time. An aggregation, so a busy day is combined
    before the shuffle instead of being sorted in one task."""
    rest = [c for c in BRONZE.fieldNames() if c not in ("symbol", "date")]
    return (
        ticks.groupBy("symbol", "date")
        .agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("r"))
        .select("symbol", "date", "r.*")
        .select(*BRONZE.fieldNames())
    )
