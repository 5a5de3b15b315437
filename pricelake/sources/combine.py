"""Bring frames of several sources to one shape and append them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schemas import BRONZE


def conform(df: DataFrame, schema: T.StructType = BRONZE) -> DataFrame:
    """Cast to ``schema``; absent or untyped (all-null) columns become typed nulls.

    The cast is strict: a value that does not fit fails the job instead of vanishing.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_sources(*frames: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Append frames by column name; with a catalog keep only its symbols."""
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(f) for f in frames]
    )
    if catalog is None:
        return rows
    return rows.join(catalog.select("symbol"), "symbol", "left_semi").select(*BRONZE.fieldNames())


def append_with_new_columns(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append where ``incoming`` may bring new columns; old rows get nulls there."""
    return current.unionByName(incoming, allowMissingColumns=True)
