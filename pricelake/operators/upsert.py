"""Last-write-wins upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.schemas import PRICE_KEY
from pricelake.sources.versioned import MonthlyTable, Staged


def latest_in_batch(
    batch: DataFrame, keys: list[str], newer_by: str, arrival: list[str] | None = None, kept: str | None = None
) -> DataFrame:
    """One row per key: newest ``newer_by``; among equals the first by the ``arrival`` columns.

    Rows that are equal in these too are told apart by their own values, so the
    outcome does not depend on task order. An aggregation rather than a ranked window:
    copies of a hot key are combined before the shuffle. Of the arrival columns only ``kept`` stays.
    """
    rest = [c for c in batch.columns if c not in keys and (c == kept or c not in (arrival or []))]
    tie = [*(arrival or []), *(c for c in rest if c not in (newer_by, kept))]
    newest = batch.withColumn("_age", -F.unix_micros(F.col(newer_by).cast("timestamp")))
    return (
        newest.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct("_age", *tie)).alias("r"))
        .select(*keys, "r.*")
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    *,
    keys: list[str] | None = None,
    newer_by: str = "ingested_at",
    arrival: list[str] | None = None,
    first_by: str | None = None,
    always_replace: bool = False,
) -> DataFrame:
    """Insert new keys; replace a stored row only by a strictly newer one.

    ``existing`` is unique on the keys. Where both tables have ``first_by``, a row of equal age that comes earlier by it
    replaces the stored one too, so the first row wins however rows are dealt to batches. With ``always_replace`` an
    incoming row wins whatever its age. One full outer join on the whole key, which spreads a hot symbol
    over its dates.
    """
    keys = keys or PRICE_KEY
    rest = [c for c in existing.columns if c not in keys]
    new = latest_in_batch(incoming, keys, newer_by, arrival, first_by)
    old_side = existing.select(*keys, F.struct(*rest).alias("_old"))
    new_side = new.select(*keys, F.struct(*rest).alias("_new"))
    stale = F.lit(True) if always_replace else (
        F.col(f"_new.{newer_by}") > F.col(f"_old.{newer_by}")
    )
    if first_by is not None:
        as_old = F.col(f"_new.{newer_by}") == F.col(f"_old.{newer_by}")
        stale = stale | (as_old & F.coalesce(F.col(f"_new.{first_by}") < F.col(f"_old.{first_by}"), F.lit(False)))
    take_new = F.col("_old").isNull() | (F.col("_new").isNotNull() & stale)
    return (
        old_side.join(new_side, keys, "full_outer")
        .select(*keys, F.when(take_new, F.col("_new")).otherwise(F.col("_old")).alias("_row"))
        .select(*keys, "_row.*")
        .select(*existing.columns)
    )


def stage_merge(
    table: MonthlyTable,
    batch: DataFrame,
    months: set[str],
    *,
    keys: list[str] | None = None,
    arrival: list[str] | None = None,
    always_replace: bool = False,
) -> Staged:
    """Write the touched months as they are after the upsert, without publishing them.

    Columns that the table does not have yet are appended to it; its older rows get nulls there. An ``arrival`` column
    that the table stores decides between batches too. One evaluation of the batch; only its months are read.
    """
    schema = table.schema
    known = set(schema.fieldNames())
    new = [c for c in batch.columns if c not in known and c not in (arrival or [])]
    old = table.read(months).select("*", *(F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in new))
    extra = [c for c in (arrival or []) if c not in known]
    absent = [c for c in known if c not in batch.columns]
    filled = batch.select("*", *(F.lit(None).cast(schema[c].dataType).alias(c) for c in absent))
    merged = upsert(
        old,
        filled.select(*(F.col(c).cast(schema[c].dataType).alias(c) if c in known else c for c in old.columns), *extra),
        keys=keys,
        arrival=arrival,
        first_by=next((c for c in (arrival or []) if c in known), None),
        always_replace=always_replace,
    )
    return table.stage(merged, months)


def merge_into(
    table: MonthlyTable,
    batch: DataFrame,
    *,
    keys: list[str] | None = None,
    arrival: list[str] | None = None,
    always_replace: bool = False,
) -> int:
    """Upsert a batch into a stored table and return the batch's row count.

    Only the months the batch touches are read and rewritten; readers see either the old
    or the new state. The batch's months and rows come from one narrow scan of it.
    """
    counts = batch.groupBy(F.expr(table.month).alias("month")).agg(F.count(F.lit(1)).alias("n")).collect()
    months = {r["month"] for r in counts}
    if not months:
        return 0
    stage_merge(table, batch, months, keys=keys, arrival=arrival, always_replace=always_replace).commit()
    return sum(r["n"] for r in counts)
