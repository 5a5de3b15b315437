"""Gold price fact and the star reads on top of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.dates import in_dates
from pricelake.operators.upsert import stage_merge, upsert
from pricelake.schemas import BRONZE, FACT_KEY
from pricelake.sources.combine import append_with_new_columns
from pricelake.sources.versioned import MonthlyTable, Staged, VersionedTable

MEASURES = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "vwap",
    "trade_count",
    "ingested_at",
]

FACT = T.StructType(
    [
        T.StructField("asset_id", T.LongType(), False),
        T.StructField("date_id", T.LongType(), False),
        *[f for f in BRONZE.fields if f.name in MEASURES],
    ]
)
FACT_MONTH = "concat_ws('-', substr(cast(date_id as string), 1, 4), substr(cast(date_id as string), 5, 2))"

# The joins to the dimensions carry no broadcast hint: Spark broadcasts a dimension when
# its size is below the session's threshold and shuffles otherwise.


def fact_rows(silver: DataFrame, assets: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        silver.join(assets.select("asset_id", "symbol"), "symbol")
        .join(dates.select("date_id", "date"), "date")
        .select(*FACT_KEY, *MEASURES)
    )


def newer_than_fact(silver: DataFrame, current: DataFrame) -> DataFrame:
    """Silver rows ingested after everything the fact already holds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    mark = F.coalesce(current.agg(F.max("ingested_at")).scalar(), epoch)
    return silver.where(F.col("ingested_at") > mark)


def fact_daily_price(
    silver: DataFrame, assets: DataFrame, dates: DataFrame, current: DataFrame | None = None
) -> DataFrame:
    """(asset_id, date_id) price fact; incremental when the current fact is given.

    New rows replace stored ones of the same key, and columns the fact does not have yet
    are appended to it.
    """
    if current is None:
        return fact_rows(silver, assets, dates)
    fresh = fact_rows(newer_than_fact(silver, current), assets, dates)
    widened = append_with_new_columns(current, fresh.limit(0)).select(
        *current.columns, *[c for c in fresh.columns if c not in current.columns]
    )
    return upsert(widened, fresh.select(*widened.columns), keys=FACT_KEY, always_replace=True)


class FactIntake:
    """What the stored fact has taken from silver: the version of each silver month, and the newest ingestion.

    A silver month whose version is another one now has changed since. So an increment reads the changed months of
    silver and of the fact, and neither table as a whole.
    """

    def __init__(self, root: str, fact: MonthlyTable, silver: MonthlyTable):
        self.fact, self.silver = fact, silver
        self.taken = VersionedTable(fact.spark, f"{root}/taken")
        self.fresh = VersionedTable(fact.spark, f"{root}/fresh", keep=1)

    def _taken(self) -> tuple[dict[str, str], dt.datetime | None]:
        stored = self.taken.read()
        rows = stored.collect() if stored is not None else []  # one row for each calendar month
        return {r["month"]: r["version"] for r in rows}, max((r["mark"] for r in rows), default=None)

    def changed_months(self) -> set[str]:
        before, _ = self._taken()
        return {m for m, v in self.silver.months().items() if before.get(m) != v}

    def stage(self, assets: DataFrame, dates: DataFrame) -> tuple[Staged, DataFrame] | None:
        """The fact's changed months with the newly ingested silver rows, and those rows; None if there are none."""
        _, mark = self._taken()
        months = self.changed_months()
        if not months:
            return None
        rows = self.silver.read(months)
        if mark is not None:
            rows = rows.where(F.col("ingested_at") > F.lit(mark))
        fresh = self.fresh.replace(fact_rows(rows, assets, dates))
        return stage_merge(self.fact, fresh, months, keys=FACT_KEY, always_replace=True), fresh

    def commit(self, fresh: DataFrame) -> None:
        """Remember the state of silver that was taken; dying before this only repeats the same increment."""
        _, mark = self._taken()
        newest = fresh.agg(F.max("ingested_at")).first()[0]
        mark = max((m for m in (mark, newest) if m is not None), default=None)
        rows = [(m, v, mark) for m, v in sorted(self.silver.months().items())]
        self.taken.replace(self.fact.spark.createDataFrame(rows, "month string, version string, mark timestamp").coalesce(1))


def star_prices(
    fact: DataFrame, assets: DataFrame, types: DataFrame, dates: DataFrame, first=None, last=None
) -> DataFrame:
    """(symbol, asset_type, date, close) through the dimensions, optionally between two dates."""
    return _through_dimensions(fact, assets, types, dates, first, last).select(
        "symbol", "asset_type", "date", "close"
    )


def star_metrics(
    metrics: DataFrame, assets: DataFrame, types: DataFrame, dates: DataFrame, first=None, last=None
) -> DataFrame:
    """Metrics by (symbol, asset_type, date) through the dimensions, optionally between two dates."""
    values = [c for c in metrics.columns if c not in FACT_KEY]
    return _through_dimensions(metrics, assets, types, dates, first, last).select(
        "symbol", "asset_type", "date", *values
    )


def _through_dimensions(
    rows: DataFrame, assets: DataFrame, types: DataFrame, dates: DataFrame, first=None, last=None
) -> DataFrame:
    """A range of dates becomes one of ``date_id``, which reaches the scan of the fact and that of the dates."""
    rows, dates = in_dates(rows, first, last), in_dates(dates, first, last)
    named = types.select("asset_type_id", F.col("name").alias("asset_type"))
    return (
        rows.join(assets.select("asset_id", "symbol", "asset_type_id"), "asset_id")
        .join(named, "asset_type_id")
        .join(dates.select("date_id", "date"), "date_id")
    )
