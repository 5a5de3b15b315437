"""A flat series: one row per calendar day with price 1."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import spine
from pricelake.schemas import BRONZE, FLAT_SOURCE


def flat_series(
    bounds: DataFrame,
    *,
    run_id: str,
    ingested_at: dt.datetime | Column,
    symbol: str = "USD",
    asset_type: str = "fx",
    source: str = FLAT_SOURCE,
) -> DataFrame:
    """Rows for every day of ``bounds`` (one row with ``start`` and ``end``)."""
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    one = F.lit(1.0)
    days = bounds.select(F.explode(spine(F.col("start"), F.col("end"))).alias("date"))
    filled = {
        "source": F.lit(source),
        "asset_type": F.lit(asset_type),
        "symbol": F.lit(symbol),
        "open": one,
        "high": one,
        "low": one,
        "close": one,
        "ingested_at": stamp.cast("timestamp"),
        "run_id": F.lit(run_id),
    }
    empty = {
        f.name: F.lit(None).cast(f.dataType)
        for f in BRONZE.fields
        if f.name not in filled and f.name != "date"
    }
    return days.withColumns({**filled, **empty}).select(*BRONZE.fieldNames())
