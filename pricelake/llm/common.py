"""What the operators of this package share: text expressions, shared folders, running offsets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
#: The same as a regular expression class (Java, Python and RE2 read it alike).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lists that note the folders made now, the innermost last.
_NOTED: ContextVar[tuple[list[str], ...]] = ContextVar("noted", default=())


def whole_text(text: Column | str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def without(text: Column, characters: str) -> Column:
    """The text without the given characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def stripped(text: Column) -> Column:
    """The text without white space at its ends."""
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """Words of the text in order."""
    inner = stripped(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS + "+"))


def count_words(text: Column) -> Column:
    """Number of words."""
    return F.size(words_of(text)).cast("long")


def carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and whole rows as ``_row``, so that no other column's name can clash."""
    return docs.select(*needed, F.struct(*docs.columns).alias("_row"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see; it goes when the driver ends.

    It lies in the folder of ``spark.checkpoint.dir``; only where that is unset (tests on one
    machine) the library sets a temporary one.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pricelake-"))
        base = context.getCheckpointDir()
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    for noted in _NOTED.get():
        noted.append(folder)
    return folder


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def folders_made() -> Iterator[list[str]]:
    """The shared folders that are made inside, in order."""
    noted: list[str] = []
    token = _NOTED.set((*_NOTED.get(), noted))
    try:
        yield noted
    finally:
        _NOTED.reset(token)


def drop_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete tables of the shared folder that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def distilled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows that ``make`` gives as a table in the shared folder; the tables written to make them go.

    For small results of large intermediate tables, which would otherwise take disk until the driver ends.
    """
    with folders_made() as made:
        result = written(make(), name)
    drop_folders(spark, made[:-1])
    return result


def range_partitions(spark: SparkSession, at_least: int = 1) -> int:
    """How many key ranges to deal rows into: the session's shuffle partitions."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_ranges(df: DataFrame, order: Sequence[str | Column], out: str = "part", ranges: int = 0) -> DataFrame:
    """Rows dealt into ranges of ``order`` and written, each with the number of its range."""
    n = ranges or range_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *order).withColumn(out, F.spark_partition_id())
    return written(dealt, "ranges")


def running_offsets(
    ranged: DataFrame, order: Sequence[str | Column], sums: dict[str, str], part: str = "part"
) -> DataFrame:
    """Add to each row of ``in_ranges`` the sums over all rows before it.

    ``sums`` maps a new column to the column that is summed. A range is summed on its own;
    the sums of whole ranges (one row for each range) then shift the ranges behind them, so no
    task sees more than one range.
    """
    totals = ranged.groupBy(part).agg(*(F.sum(v).alias(f"_{k}") for k, v in sums.items()))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select(part, *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    inside = W.partitionBy(part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = ranged.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()})
    return (
        local.join(F.broadcast(shift), part)  # one row for each range
        .withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums})
        .drop(*(f"_{k}" for k in sums))
    )

