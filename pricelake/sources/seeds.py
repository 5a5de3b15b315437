"""Seed CSV files and detection of the changed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.schemas import ASSET_CATALOG


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ASSET_CATALOG).option("header", True).csv(path)


def read_seed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(seed_name, content) of every CSV file in ``folder``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select(F.regexp_extract("path", r"([^/]+)\.csv$", 1).alias("seed_name"), "content")
    )


def fingerprints(files: DataFrame) -> DataFrame:
    """(seed_name, sha256) of (seed_name, content)."""
    return files.select("seed_name", F.sha2(F.col("content").cast("binary"), 256).alias("sha256"))


def changed_files(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Names whose fingerprint differs from the stored one; unknown files count as changed."""
    known = stored.select("seed_name", F.col("sha256").alias("stored_sha256"))
    return (
        fingerprints(files)
        .join(known, "seed_name", "left")
        .where(~F.col("sha256").eqNullSafe(F.col("stored_sha256")))
        .select("seed_name")
    )


def write_fingerprints(files: DataFrame, path: str) -> None:
    """Replace the stored fingerprints."""
    (
        fingerprints(files)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )
