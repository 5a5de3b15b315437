"""Answer tables as Parquet and CSV, published together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelake.sources.versioned import _delete, _mark, committed_versions


def write_answer(
    df: DataFrame, root: str, name: str, order_by: list[str] | None = None
) -> None:
    """Write ``name`` in both formats; computed once, the CSV is read off the Parquet.

    With ``order_by`` the files are globally ordered (a distributed sort).
    """
    if order_by:
        df = df.orderBy(*order_by)
    folder = f"{root.rstrip('/')}/{name}"
    spark = df.sparkSession
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(f"{folder}/parquet")
    )
    stored = spark.read.schema(df.schema).parquet(f"{folder}/parquet")
    stored.write.mode("overwrite").option("header", True).csv(f"{folder}/csv")


class Answers:
    """The answer tables of a run under ``root``/<number>; readers see those of the last run that wrote all of them."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _newest(self) -> int | None:
        return max(committed_versions(self.spark, self.root), default=None)

    def folder(self, name: str, kind: str = "parquet") -> str:
        """Where the published answer lies in one of its formats."""
        newest = self._newest()
        if newest is None:
            raise LookupError(f"no answers under {self.root}")
        return f"{self.root}/{newest}/{name}/{kind}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.folder(name))

    def publish(self, answers: dict[str, DataFrame], order: dict[str, list[str]] | None = None, then=None) -> list[str]:
        """Write all tables, then show them to readers at once; returns their names.

        A write that fails leaves the last answers as they are. ``then`` takes a function that reads a table just written and returns
        further ones made from them.
        """
        number = (self._newest() or 0) + 1
        base = f"{self.root}/{number}"
        names = []
        for batch in (lambda: answers, lambda: then(lambda n: self.spark.read.parquet(f"{base}/{n}/parquet")) if then else {}):
            for name, df in batch().items():
                write_answer(df, base, name, (order or {}).get(name))
                names.append(name)
        _mark(self.spark, base)
        for old in committed_versions(self.spark, self.root)[: -self.keep]:
            _delete(self.spark, f"{self.root}/{old}")
        return names
