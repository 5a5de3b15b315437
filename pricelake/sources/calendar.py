"""Trading calendar from a supplied set of trading days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.dates import spine


def trading_calendar(bounds: DataFrame, trading_days: DataFrame) -> DataFrame:
    """Every day of ``bounds`` (start, end) with a flag whether it is a trading day."""
    days = bounds.select(F.explode(spine(F.col("start"), F.col("end"))).alias("date"))
    open_days = trading_days.select("date").distinct().withColumn("listed", F.lit(True))
    return days.join(open_days, "date", "left").select(
        "date", F.coalesce("listed", F.lit(False)).alias("is_trading_day")
    )


def write_calendar(calendar: DataFrame, path: str) -> None:
    """Replace the stored calendar."""
    calendar.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
