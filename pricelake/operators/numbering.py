"""Row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.sources.scratch import stored_once

_SAMPLE_PER_RANGE = 16


def number_rows(
    df: DataFrame, order: list[Column], out: str, *, start: Column | int = 1, ranges: int | None = None
) -> DataFrame:
    """Number the rows 1..n by ``order`` (ascending, must be unique per row), without one task sorting them.

    The rows are written once, split into ``ranges`` key ranges (the session's shuffle partitions by default) at boundaries
    drawn from a hash sample of bounded size, numbered inside each range, and shifted by the number of rows in earlier
    ranges. The input is evaluated once, while the plan is built; what is sent to all tasks is one boundary and one count
    for each range.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = stored_once(df.withColumn("_key", F.struct(*order)), "numbering")
    sample = (
        keyed.select("_key", F.xxhash64("_key").alias("_h"))
        .orderBy("_h", "_key")
        .limit(ranges * _SAMPLE_PER_RANGE)
        .agg(F.array_sort(F.collect_list("_key")).alias("s"))
    )
    bounds = sample.select(
        F.filter("s", lambda _, i: (i + 1) % _SAMPLE_PER_RANGE == 0)
    ).scalar()
    ranged = keyed.withColumn("_bounds", bounds).withColumn(
        "_range", F.size(F.filter("_bounds", lambda b: b < F.col("_key")))
    ).drop("_bounds")
    sizes = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.collect_list(F.struct("_range", "n")))
        .scalar()
    )
    first = start if isinstance(start, Column) else F.lit(start)
    within = F.row_number().over(W.partitionBy("_range").orderBy("_key"))
    return (
        ranged.withColumn("_in", within)
        .withColumn("_sizes", sizes)
        .withColumn(
            out,
            F.aggregate(
                F.filter("_sizes", lambda s: s["_range"] < F.col("_range")),
                F.lit(0).cast("long"),
                lambda acc, s: acc + s["n"],
            )
            + F.col("_in")
            + first.cast("long")
            - 1,
        )
        .drop("_key", "_range", "_in", "_sizes")
    )
