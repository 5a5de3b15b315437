"""Mixing sources to target weights by a low-discrepancy schedule.

Each source gets a target: its share by weight of ``share`` times all words, at most ``cap`` times
its own words, the excess shared again. A schedule of slots follows the golden ratio: slot i falls
on the point frac(i * phi) of the targets laid end to end, so any stretch of the schedule holds the
sources in proportion. Points are integers of 62 bits, so slots far out differ as the first ones do. The slots of a source are ranked; its documents, shuffled by hash and laid end
to end, are cut into blocks of ``block_words`` words, and rank r takes block r modulo their number,
in at most ``cap`` passes. A source is so taken up to a few blocks from its target.

Everything is DataFrame functions. Running sums go over key ranges of (source, shuffle order), so a
source with a third of all documents is summed by many tasks; slots are ranked in stretches of the
schedule. One-row totals reach the driver.

Defined cases: a null text has no words; a null source is the last source; repeated rows are
documents of their own; a document without words takes nothing; an empty table gives no rows;
further columns are ignored. Reruns agree: nothing depends on the order of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import carried, count_words, in_ranges, running_offsets, whole_text, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 32
#: The golden ratio's fraction in 62 bits: (sqrt(5) - 1) / 2 times 2^62, made odd.
GOLDEN = (math.isqrt(5 << 124) - (1 << 62)) >> 1 | 1
#: Slots that are ranked together.
STRETCH = 1 << 16
_CELLS = 1024


@dataclass(frozen=True)
class Mix:
    """documents with their words taken; sources with targets; schedule of slots."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_no (by code point, null last), source_size, start, target, first, last (on the targets' line)."""
    order = [F.col("source").asc_nulls_last()]
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    numbered = running_offsets(in_ranges(totals, order), order, {"source_no": "one", "start": "source_size"})
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_no") % len(weights)).cast("int"))
    sources = written(
        numbered.select(
            "source", "source_no", "source_size", "start", weight.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")
        ),
        "sources",
    )
    words, open_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    goal, level, full_before = share * (words or 0), 0.0, -1
    if open_weight:
        level = goal / open_weight
    while True:  # each turn fills at least one more source, or ends
        full = F.col("most") <= F.col("weight") * F.lit(level)
        n_full, held, rest = sources.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n_full == full_before or not rest:
            break
        full_before, level = n_full, (goal - (held or 0.0)) / rest
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    placed = sources.withColumn("target", target).withColumn("room", F.round("target").cast("long"))
    lined = running_offsets(in_ranges(placed, ["source_no"]), ["source_no"], {"first": "room"})
    return written(lined.withColumn("last", F.col("first") + F.col("room")).drop("part", "weight", "most", "room"), "targets")


def _halves(x: Column) -> tuple[Column, Column]:
    """The high and the low 31 bits of a number below 2^62: their products fit a long."""
    return F.shiftright(x, 31), x.bitwiseAND(F.lit((1 << 31) - 1))


def slot_point(slot: Column, line: int) -> Column:
    """Where a slot falls on a line of ``line`` words: floor(line * frac(slot * phi)), in whole numbers (both below 2^62)."""
    mask = F.lit((1 << 31) - 1)
    (s1, s0), (g1, g0) = _halves(slot), (F.lit(GOLDEN >> 31), F.lit(GOLDEN & (1 << 31) - 1))
    crossed = ((s1 * g0).bitwiseAND(mask) + (s0 * g1).bitwiseAND(mask)).bitwiseAND(mask)
    point = (F.shiftleft(crossed, 31) + s0 * g0).bitwiseAND(F.lit((1 << 62) - 1))
    (p1, p0), (n1, n0) = _halves(point), (F.lit(line >> 31).cast("long"), F.lit(line & (1 << 31) - 1).cast("long"))
    return p1 * n1 + F.shiftright(p1 * n0 + p0 * n1 + F.shiftright(p0 * n0, 31), 31)


def slot_schedule(sources: DataFrame, block_words: int = BLOCK_WORDS, cap: int = CAP) -> DataFrame:
    """slot, source_no, rank, block: which block each slot takes."""
    spark = sources.sparkSession
    line, n_sources = sources.agg(F.max("last"), F.count(F.lit(1))).first()
    line = line or 0
    width = max(1, -(-line // max(_CELLS, n_sources)))  # cells of the line: a slot meets the sources of its cell only
    cells = sources.where("last > first").select(
        "source_no", "first", "last", "source_size",
        F.explode(F.sequence(F.expr(f"first div {width}"), F.expr(f"(last - 1) div {width}"))).alias("cell"),
    )
    slots = spark.range((line + block_words // 2) // block_words).select(F.col("id").alias("slot"), slot_point(F.col("id"), line).alias("at"))
    drawn = (
        slots.withColumn("cell", F.expr(f"at div {width}"))
        .join(cells, "cell")
        .where("at >= first AND at < last")
        .select("slot", "source_no", F.ceil(F.col("source_size") / block_words).alias("blocks"), F.floor(F.col("slot") / STRETCH).alias("stretch"))
    )
    earlier = W.partitionBy("source_no").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    before = drawn.groupBy("source_no", "stretch").agg(F.count(F.lit(1)).alias("n")).select(
        "source_no", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(W.partitionBy("source_no", "stretch").orderBy("slot")) - 1
    ranked = drawn.withColumn("inside", inside).join(before, ["source_no", "stretch"])
    return (
        ranked.withColumn("rank", F.col("before") + F.col("inside"))
        .where(F.col("rank") < F.col("blocks") * cap)
        .select("slot", "source_no", "rank", (F.col("rank") % F.col("blocks")).alias("block"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, block_words: int = BLOCK_WORDS) -> Mix:
    """Documents with doc_id, source, fp (hash of the text), size, source_size, target, taken."""
    text = whole_text()
    sized = written(
        docs.select("doc_id", "source", count_words(text).alias("size"), F.xxhash64(text).alias("fp"), F.xxhash64("doc_id", text).alias("shuffle")),
        "sized",
    )
    sources = source_targets(sized, weights, share, cap)
    known = sources.select(F.col("source").alias("_source"), "source_no", "start", "source_size", "target")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("one", F.lit(1).cast("long"))
    order = ["source_no", "shuffle", "doc_id", "fp"]
    laid = running_offsets(in_ranges(rows, order), order, {"row": "one", "before": "size"})
    begin = F.col("before") - F.col("start")
    blocks = F.when(
        F.col("size") > 0,
        F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words)),
    )
    pieces = laid.withColumn("begin", begin).withColumn("block", F.explode_outer(blocks))
    schedule = slot_schedule(sources, block_words, cap)
    uses = schedule.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("uses"))
    overlap = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest("begin", F.col("block") * block_words)
    used = pieces.join(uses, ["source_no", "block"], "left").withColumn("words", F.coalesce(overlap * F.col("uses"), F.lit(0)))
    keep = ["doc_id", "source", "fp", "size", "source_size", "target"]
    taken = used.groupBy("row", *keep).agg(F.sum("words").cast("long").alias("taken"))
    return Mix(taken.select(*keep, "taken"), sources, schedule)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them: whole documents, none, one or several times.

    The blocks that are used once more than others lie side by side, so at most a document or two of
    a source is taken in part; those are rounded to whole documents.
    """
    keys = ["doc_id", "source", "fp"]
    taken = mix(docs, **settings).documents.where("size > 0").groupBy(*keys, "size").agg(F.avg("taken").alias("taken"))
    copies = taken.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("fp").alias("_fp"),
        F.round(F.col("taken") / F.col("size")).cast("int").alias("_copies"),
    ).where("_copies > 0")
    same = (F.xxhash64(whole_text()) == F.col("_fp")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    rows = carried(docs, "doc_id", "source", "text")
    return rows.join(copies, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")
