"""New bronze files into silver, each exactly once per checkpoint, replay harmless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricelake.operators.upsert import merge_into
from pricelake.schemas import BRONZE
from pricelake.sources.bronze import STORED, TICK
from pricelake.sources.versioned import MonthlyTable


def stream_bronze(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Bronze rows of files that have not been read yet."""
    reader = spark.readStream.schema(STORED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def merge_available(
    bronze: DataFrame, table: MonthlyTable, checkpoint: str
) -> StreamingQuery:
    """Merge everything that has landed and stop.

    A batch goes through the same upsert as a normal ingest. Late rows need no watermark:
    the stored ingestion time decides which row wins, and a batch that is replayed after a
    failure changes nothing. The checkpoint folder belongs on shared storage.
    """

    def merge(batch: DataFrame, _: int) -> None:
        rows = batch.select(*BRONZE.fieldNames(), TICK).persist()
        merge_into(table, rows, arrival=[TICK])
        rows.unpersist()

    return (
        bronze.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
