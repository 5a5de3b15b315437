"""From documents to packed training sequences: five stages, each a table in the shared folder.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns the
columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import exact_dedup, near_dedup, packing, quality_rules, source_mix
from pricelake.llm.common import drop_folders, folders_made, written
from pricelake.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the smallest doc_id stays."""
    return near_dedup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target sizes: a document stays not at all, once or twice."""
    return source_mix.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    # workers still hold memory of the stages before
    pieces = packing.pack(docs, slice_bytes=1_000_000, memory=400_000)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mix", mixed),
    ("packing", packed),
]

# packing needs the tokenizer; a test runs all stages against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; tables of a stage go when the next one has its own."""
    configure(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with folders_made() as made:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_folders(spark, [*before, *made[:-1]])
        before = made[-1:]
    return docs
