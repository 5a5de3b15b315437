"""Bronze Parquet: one folder per (source, asset_type, ingested_date)."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.contract import (
    BRONZE_RULES,
    ContractError,
    coerce,
    extra_columns,
    guard,
    missing_columns,
    report,
)
from pricelake.schemas import BRONZE
from pricelake.sources.combine import conform

PARTITIONS = ["source", "asset_type", "ingested_date"]
#: Order of ticks within a day, null for daily rows; stored in bronze, not in silver.
TICK = "ts_ms"
_ROWS = T.StructType([*BRONZE.fields, T.StructField(TICK, T.LongType())])
STORED = T.StructType([*_ROWS.fields, T.StructField("ingested_date", T.DateType())])


class Written(NamedTuple):
    """What a batch put into bronze: rows, the span of its ingestion days and of its dates."""

    rows: int
    first_day: dt.date | None
    last_day: dt.date | None
    first_date: dt.date | None = None
    last_date: dt.date | None = None


def write_bronze(rows: DataFrame, root: str) -> Written:
    """Publish a batch and return its row count and ingestion days.

    The contract is checked inside the write itself, so good data is read once; a
    violation fails the job before anything is committed, and only then all violations
    are counted for the error. Running the same day again replaces its folders
    (dynamic overwrite). An empty batch writes nothing.
    """
    wrong = [("no_extra_columns", c, 1) for c in extra_columns(rows.drop(TICK), BRONZE)]
    wrong += [("column_present", c, 1) for c in missing_columns(rows, BRONZE)]
    if wrong:
        raise ContractError(wrong)
    counted = Observation("bronze")
    checked = (
        guard(conform(rows, _ROWS), BRONZE_RULES)
        .select(*_ROWS.fieldNames(), F.to_date("ingested_at").alias("ingested_date"))
        .observe(
            counted,
            F.count(F.lit(1)).alias("rows"),
            F.min("ingested_date").alias("first_day"),
            F.max("ingested_date").alias("last_day"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        # lets adaptive execution split a folder that holds most of the batch
        .hint("rebalance", *PARTITIONS)
    )
    try:
        (
            checked.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS)
            .parquet(root)
        )
    except PySparkException as failed:
        coerced, cast_rules = coerce(rows, BRONZE)
        every = report(coerced, [*cast_rules, *BRONZE_RULES])
        found = [r for r in every.collect() if r["violations"]]
        if found:
            raise ContractError([tuple(r) for r in found]) from failed
        raise
    try:
        seen = counted.get
    except Py4JJavaError:
        # Spark found the batch to be empty while planning and dropped the observation
        return Written(0, None, None)
    return Written(*(seen[f] for f in Written._fields))


def read_bronze(spark: SparkSession, root: str, written: Written | None = None) -> DataFrame:
    """Bronze rows with ``ingested_date``; of one batch, only its days' folders are read."""
    rows = spark.read.schema(STORED).parquet(root)
    if written is None:
        return rows
    return rows.where(F.col("ingested_date").between(written.first_day, written.last_day))
