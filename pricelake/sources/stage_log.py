"""JSON-lines timing log."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.schemas import STAGE_LOG


def read_stage_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of the log; blank lines are skipped, a missing log is empty.

    ``meta`` stays JSON text because its keys differ per stage.
    """
    try:
        return spark.read.schema(STAGE_LOG).option("mode", "FAILFAST").json(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in (err.getCondition() or ""):
            raise
        return spark.createDataFrame([], STAGE_LOG)


def parse_stage_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Records held as JSON text lines."""
    return (
        lines.where(F.trim(line) != "")
        .select(F.from_json(line, STAGE_LOG, {"mode": "FAILFAST"}).alias("r"))
        .select("r.*")
    )


def timed_stage(
    spark: SparkSession,
    path: str,
    stage: str,
    action: Callable[[dict], object],
    *,
    run_label: str | None = None,
    **meta,
):
    """Run ``action`` and append one record, also when it fails.

    ``action`` receives the meta dictionary and may add to it.
    """
    started = dt.datetime.now(dt.UTC)
    clock = time.perf_counter()
    status = "error"
    try:
        result = action(meta)
        status = "ok"
        return result
    finally:
        record = {
            "stage": stage,
            "started_at": started.isoformat(),
            "duration_s": round(time.perf_counter() - clock, 6),
            "status": status,
            "meta": meta,
            "run_label": run_label or f"daily-{started.date().isoformat()}",
        }
        line = json.dumps(record, default=str)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
