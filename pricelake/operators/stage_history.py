"""Analytics over the timing log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNLABELLED = "unlabeled"
INGEST_STAGE = "ingest:total"
QUALITY_STAGE = "ingest:dq_assertions"
# Fixed value: an older label that is shown under its present name.
LABEL_ALIASES = {"clean_baseline": "incremental_run"}


def _micros(started_at: Column) -> Column:
    return F.unix_micros(started_at.cast("timestamp"))


def _label() -> Column:
    return F.coalesce(F.nullif(F.col("run_label"), F.lit("")), F.lit(UNLABELLED))


def numeric_meta(log: DataFrame, by: list[str]) -> DataFrame:
    """(by..., key, total): numbers in ``meta`` cut to integers and summed.

    Strings and booleans do not count, also when they look like numbers.
    """
    entries = F.expr("cast(try_parse_json(meta) as map<string, variant>)")
    kind = F.expr("schema_of_variant(value)")
    is_number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return (
        log.select(*by, F.explode(entries))
        .where(is_number)
        .groupBy(*by, "key")
        .agg(F.sum(F.expr("cast(try_variant_get(value, '$', 'double') as bigint)")).alias("total"))
    )


def stage_rollup(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per stage (and per ``by``): counts, durations, memory, summed meta."""
    keys = [*(by or []), "stage"]
    delta = F.col("rss_mb_end") - F.col("rss_mb_start")
    base = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("duration_s").alias("total_s"),
        F.avg("duration_s").alias("mean_s"),
        F.max("duration_s").alias("max_s"),
        F.when(F.coalesce(F.bool_or(F.col("status") == "error"), F.lit(False)), "error")
        .otherwise("ok")
        .alias("status"),
        F.max("rss_mb_peak").alias("peak_rss_mb"),
        F.round(F.sum(delta), 1).alias("delta_rss_mb"),
        F.min("started_at").alias("first_started_at"),
    )
    meta = (
        numeric_meta(log, keys)
        .groupBy(*keys)
        .agg(
            F.to_json(
                F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "total"))))
            ).alias("meta")
        )
    )
    return base.join(meta, keys, "left").withColumn("meta", F.coalesce("meta", F.lit("{}")))


def wall_clock(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Seconds from the first start to the last end; 0 for an empty log."""
    start = _micros(F.col("started_at"))
    end = start + F.round(F.col("duration_s") * 1_000_000).cast("long")
    span = (F.max(end) - F.min(start)) / F.lit(1_000_000)
    return log.groupBy(*(by or [])).agg(F.coalesce(span, F.lit(0.0)).alias("wall_clock_s"))


def labelled(log: DataFrame) -> DataFrame:
    """Records with their run label; unlabelled ones only where no label exists at all."""
    any_label = log.agg(F.bool_or(_label() != UNLABELLED)).scalar()
    return (
        log.withColumn("run_label", _label())
        .withColumn("_any", any_label)
        .where((F.col("run_label") != UNLABELLED) | ~F.col("_any"))
        .drop("_any")
    )


def display_label(label: Column) -> Column:
    shown = F.when(
        label.startswith("daily-"), F.concat(F.lit("Daily run · "), F.substr(label, F.lit(7)))
    )
    for old, new in LABEL_ALIASES.items():
        shown = shown.when(label == old, new)
    return shown.otherwise(label)


def run_groups(log: DataFrame) -> DataFrame:
    """One row per run label, oldest first."""
    return (
        labelled(log)
        .groupBy("run_label")
        .agg(F.min("started_at").alias("first_started_at"), F.count(F.lit(1)).alias("records"))
        .withColumn("display", display_label(F.col("run_label")))
        .orderBy("first_started_at", "run_label")
    )


def _meta(key: str) -> Column:
    return F.get_json_object("meta", f"$.{key}")


def ingest_windows(log: DataFrame) -> DataFrame:
    """Per run label the window of its first ingest record that names one."""
    both = F.col("w_start").isNotNull() & F.col("w_end").isNotNull()
    return (
        labelled(log)
        .where(F.col("stage") == INGEST_STAGE)
        .select("run_label", "started_at", _meta("start_date").alias("w_start"), _meta("end_date").alias("w_end"))
        .where(both)
        .groupBy("run_label")
        .agg(F.min_by(F.struct("w_start", "w_end"), F.struct("started_at", "w_start", "w_end")).alias("w"))
        .select("run_label", F.col("w.w_start").alias("start_date"), F.col("w.w_end").alias("end_date"))
    )


def data_window(log: DataFrame) -> DataFrame:
    """Union of all forward ingest windows, else the dates the log was captured on."""
    start, end = _meta("start_date"), _meta("end_date")
    usable = (F.col("stage") == INGEST_STAGE) & (start <= end)
    day = F.substring("started_at", 1, 10)
    return log.agg(
        F.min(F.when(usable, start)).alias("w_start"),
        F.max(F.when(usable, end)).alias("w_end"),
        F.min(day).alias("d_start"),
        F.max(day).alias("d_end"),
    ).select(
        F.coalesce("w_start", "d_start").alias("start_date"),
        F.coalesce("w_end", "d_end").alias("end_date"),
    )


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows per second; null without rows or time."""
    return F.when((rows > 0) & (seconds > 0), rows / F.nullif(seconds, F.lit(0.0)))


def run_kpis(log: DataFrame) -> DataFrame:
    """Per run label: span, silver rows and rate, failing stages, quality issues, peak memory.

    One grouped aggregation by (run, stage), then by run.
    """
    runs = labelled(log)
    start = _micros(F.col("started_at"))
    issues = [F.coalesce(_meta(k).try_cast("bigint"), F.lit(0).cast("long")) for k in
              ("duplicate_keys", "null_close_rows", "out_of_range_rows")]
    silver = F.when(F.col("stage") == INGEST_STAGE, _meta("silver_rows_merged").try_cast("double").cast("bigint"))
    is_quality = F.col("stage") == QUALITY_STAGE
    per_stage = runs.groupBy("run_label", "stage").agg(
        F.min(start).alias("first"),
        F.max(start + F.round(F.col("duration_s") * 1_000_000).cast("long")).alias("last"),
        F.sum("duration_s").alias("total_s"),
        F.sum(silver).alias("silver_rows"),
        F.coalesce(F.bool_or(F.col("status") == "error"), F.lit(False)).alias("failed"),
        F.min_by(F.when(is_quality, issues[0] + issues[1] + issues[2]), "started_at").alias("dq_issues"),
        F.max("rss_mb_peak").alias("peak_rss_mb"),
    )
    per_run = per_stage.groupBy("run_label").agg(
        ((F.max("last") - F.min("first")) / F.lit(1_000_000)).alias("wall_clock_s"),
        F.coalesce(F.sum("silver_rows"), F.lit(0).cast("long")).alias("silver_rows"),
        F.sum(F.when(F.col("stage") == INGEST_STAGE, F.col("total_s"))).alias("_ingest_s"),
        F.count_if("failed").alias("errors"),
        F.max("dq_issues").alias("dq_issues"),
        F.max("peak_rss_mb").alias("peak_rss_mb"),
    )
    return per_run.select(
        "run_label",
        "wall_clock_s",
        "silver_rows",
        throughput(F.col("silver_rows"), F.col("_ingest_s")).alias("rows_per_s"),
        "errors",
        "dq_issues",
        "peak_rss_mb",
    )
