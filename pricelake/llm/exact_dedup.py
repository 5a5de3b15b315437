"""Exact deduplication through an extendible-hash index in shared files.

Texts are equal when identical after lower-casing A-Z. Each text gets a 64-bit key; the leading
bits of the key are its slot in a directory, which starts with one bucket and doubles its depth while
a bucket holds more keys than ``capacity``: only overfull buckets split, the others keep their
local depth. The slots send the texts to owner tasks, each with some key ranges inside the slots; an owner compares
texts of one slot and key by their bytes, and texts that share a key form a chain below it. What is found for a
text is written to the index, and documents read it there.

Everything is DataFrame operations. Keys that hold more than one in ``HOT_KEYS`` of all rows have their copies combined
before they go to their owner, so a text that makes up a third of the corpus arrives there as one row. The depth has no
limit of its own: with keys spread evenly it is a few more than the binary logarithm of texts by capacity.

Defined cases: a null text counts as empty, all empty texts are one group; rows that repeat both
``doc_id`` and text are one document, they stay or go together (each counts in ``group_size``); a
null ``doc_id`` is smaller than any other; further columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import ascii_lower, carried, distilled, range_partitions, shared_folder, whole_text, written

#: Keys that one bucket may hold before it splits.
CAPACITY = 4096
#: A key with more than one in so many of all rows is hot; so there are at most that many.
HOT_KEYS = 1 << 16
#: Bits of the keys that are counted at once while the directory grows.
_STEP = 16
#: Bits by which a slot falls into parts: so many more than there are tasks that they spread evenly.
_PART_BITS = 4


@dataclass(frozen=True)
class ExactIndex:
    """entries: doc_id, text_sha256, hash_key of every document; directory: the buckets; index: one row per text."""

    entries: DataFrame
    directory: DataFrame
    index: DataFrame
    depth: int


def leading_bits(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Slots of the directory over distinct keys: slot (the key's first bits at global depth), depth, bucket; and that depth.

    Only whether buckets are overfull reaches the driver.
    """
    spark = keys.sparkSession
    leaves, parents, depth, counted = [], None, 0, -1
    while True:
        parent = parents.select(F.col("bucket").alias("_parent")) if parents is not None else None
        if depth > counted:
            under = keys
            if parent is not None:
                under = keys.join(parent, leading_bits(F.col("hash_key"), depth - 1) == F.col("_parent"), "left_semi")
            counted = min(64, depth + _STEP)
            counts = written(under.groupBy(leading_bits(F.col("hash_key"), counted).alias("bits")).agg(F.count(F.lit(1)).alias("n")), "key-counts")
        level = counts.groupBy(F.shiftrightunsigned("bits", counted - depth).alias("bucket")).agg(F.sum("n").alias("n"))
        if parent is not None:
            level = level.join(parent, F.shiftrightunsigned("bucket", 1) == F.col("_parent"), "left_semi")
        level = written(level, "directory-level")
        overfull = level.where(F.col("n") > capacity)
        last = overfull.isEmpty()
        leaves.append((level if last else level.where(F.col("n") <= capacity), depth))
        if last:
            break
        parents, depth = overfull, depth + 1
    slots = None
    for leaf, local in leaves:
        width = 1 << (depth - local)
        first = F.col("bucket") * F.lit(width)
        part = leaf.select(
            F.explode(F.sequence(first, first + F.lit(width - 1))).alias("slot"),
            F.lit(local).alias("depth"),
            F.lpad(F.conv(F.col("bucket").cast("string"), 10, 2), local, "0").alias("bucket") if local else F.lit("").alias("bucket"),
        )
        slots = part if slots is None else slots.unionByName(part)
    directory = shared_folder(spark, "directory")
    slots.write.parquet(directory)
    return spark.read.schema(slots.schema).parquet(directory), depth


def owner_groups(rows: DataFrame, keys: DataFrame, depth: int) -> DataFrame:
    """One row for each distinct text: slot, hash_key, norm, keep_id, group_size; grouped where the owner of its part of a slot is.

    ``rows`` are doc_id, hash_key, norm; ``keys`` are hash_key, n (its rows). Nothing is shuffled after the owners grouped.
    Slots are about as many as tasks, so whole ones would leave several to one task and none to others; owners take parts of them.
    """
    total = keys.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(keys.where((F.col("n") > 1) & (F.col("n") > total // HOT_KEYS)).select("hash_key"))  # at most HOT_KEYS keys
    found = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    combined = rows.join(hot, "hash_key", "left_semi").groupBy("hash_key", "norm").agg(*found)
    others = rows.join(hot, "hash_key", "left_anti").select("hash_key", "norm", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    sent = combined.unionByName(others).withColumn("slot_part", leading_bits(F.col("hash_key"), min(64, depth + _PART_BITS)))
    owned = sent.repartition(2 * range_partitions(rows.sparkSession), "slot_part")
    groups = owned.groupBy("slot_part", "hash_key", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return groups.select(leading_bits(F.col("hash_key"), depth).alias("slot"), "hash_key", "norm", "keep_id", "group_size")


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> ExactIndex:
    """Index all texts: one entry for each distinct text, in files ordered by bucket and key."""
    text = ascii_lower(whole_text())
    rows = docs.select("doc_id", text.alias("norm")).withColumn("hash_key", F.xxhash64("norm"))
    entries = written(rows.select("doc_id", "hash_key", F.sha2("norm", 256).alias("text_sha256")), "entries")
    keys = written(entries.groupBy("hash_key").agg(F.count(F.lit(1)).alias("n")), "keys")
    directory, depth = build_directory(keys, capacity)
    groups = owner_groups(rows, keys, depth).select(
        "slot", "hash_key", F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").alias("n_bytes"), "keep_id", "group_size",
    )
    placed = written(groups, "groups").join(directory, "slot").drop("slot")
    chain = F.row_number().over(W.partitionBy("bucket", "hash_key").orderBy("text_sha256"))
    owned = placed.withColumn("chain", chain).repartitionByRange("bucket", "hash_key")
    index = written(owned.sortWithinPartitions("bucket", "hash_key", "chain"), "exact-index")
    return ExactIndex(entries, directory, index, depth)


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every document, and its bucket."""
    found = build_index(docs, capacity)
    index = found.index.select("hash_key", "text_sha256", "keep_id", "group_size", "bucket", "chain")
    return found.entries.join(index, ["hash_key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "bucket", "chain",
    )


def drop_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with their own columns.

    A document is told from others by ``doc_id`` and text, so the join takes both.
    """
    def copies() -> DataFrame:
        found = exact_duplicates(docs, capacity).where(~F.col("kept"))
        return found.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()

    gone = distilled(docs.sparkSession, copies, "copies")
    digest = F.sha2(ascii_lower(whole_text()), 256)
    keyed = carried(docs, "doc_id", "text").withColumn("_of", digest)
    same = (F.col("_of") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return keyed.join(gone, same, "left_anti").select("_row.*")
