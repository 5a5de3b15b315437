"""Collocations: phrases whose words occur together more often than apart, by language.

Texts become a dictionary of overlapping chunks with the number of times each was parsed (``prefix_free``): a passage
that thousands of documents share is one chunk. Phrases are counted inside distinct chunks, weighted; first words,
then pairs of frequent words, then longer phrases made of frequent pairs, since a phrase is not more frequent than its parts.
Which words and pairs are frequent goes to the tasks as a table of ``BITS`` bits, whatever the corpus: it saves counting, and what else it
lets through fails the exact counts. All counting adds up inside a slice, inside a task and then by phrase, so that a word or language
with a third of all occurrences is a row for each task. Scores are whole-number arithmetic in decimals.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count each; a candidate's worst cut is the
lowest score, then the shortest first part; equal scores rank by count, then phrase in byte order; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import range_partitions, written
from pricelake.llm.prefix_free import Bits, count, frequent_bits, parse

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
BITS = 1 << 26
_COUNTS = "lang string, phrase string, n long"


def dictionary(docs: DataFrame, overlap: int = MAX_WORDS - 1) -> DataFrame:
    """lang, chunk, core, n: distinct chunks and how often they were parsed."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    parsed = rows.mapInArrow(parse(overlap), "lang string, chunk string, core int, n long")
    return parsed.groupBy("lang", "chunk", "core").agg(F.sum("n").alias("n"))


def _bits(phrases: DataFrame, size: int) -> Broadcast:
    """The bits of the phrases, for all tasks; ``size`` bits at most come to the driver."""
    places = phrases.mapInArrow(frequent_bits(Bits(size)), "place long").select((F.col("place") + 1).alias("place"))
    table = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    width = 4096  # bytes in a bitmap
    words = np.zeros((size // 8 // width + 1) * width, np.uint8)
    for bucket, bits in table.collect():
        words[(bucket - 1) * width : (bucket - 1) * width + len(bits)] = np.frombuffer(bits, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(words)


def _test(bits: Broadcast | None, size: int):
    return bits and (lambda: Bits(size, bits.value))


def phrase_counts(chunks: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Occurrences of all phrases that have ``min_count`` of them (lang, phrase, words, f), and of all words by language (lang, n)."""

    def counted(lengths: range, words: Broadcast | None, pairs: Broadcast | None) -> DataFrame:
        grams = chunks.mapInArrow(count(lengths, _test(words, bits), _test(pairs, bits)), _COUNTS)
        sums = grams.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
        return written(sums.withColumn("words", F.size(F.split("phrase", " "))), f"phrases-{lengths[0]}")

    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("core")).alias("n"))
    levels = [counted(range(1, 2), None, None)]
    words = _bits(levels[0], bits)
    levels.append(counted(range(2, 3), words, None))
    if max_words > 2:
        levels.append(counted(range(3, max_words + 1), None, _bits(levels[1], bits)))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found, totals


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of phrases of two words or more, by their worst cut."""
    parts = F.split("phrase", " ")
    cuts = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({
        "first": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " "),
    })
    left = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # every part of a frequent phrase is frequent
    whole = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    score = F.expr("cast(1000 as decimal(4,0)) * _a * _n div (_l * _r)")
    whole = whole.withColumns({f"_{c}": v for c, v in big.items()}).withColumn("score", score)
    worst = F.min(F.struct("score", "k", "l", "r")).alias("worst")
    best = whole.groupBy("lang", "phrase", "words", "a", "n").agg(worst)
    return best.select("lang", "phrase", "words", "a", "worst.l", "worst.r", "n", "worst.score")


def outermost(candidates: DataFrame, found: DataFrame, share: int = 100) -> DataFrame:
    """Candidates that no longer phrase with ``share`` percent of their occurrences contains.

    If one of several words more does, so does one of a single word more, because counts only fall with length.
    """
    parts = F.split("phrase", " ")
    longer = found.where("words > 2").select(
        "lang", F.explode(F.array(F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " "))).alias("phrase"), F.col("f").alias("_f")
    )
    largest = longer.groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    joined = candidates.join(largest, ["lang", "phrase"], "left")
    return joined.where(F.col("_f").isNull() | (100 * F.col("_f") < share * F.col("a"))).drop("_f")


def top_of_language(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first rows of each language with their rank; a language is ranked in parts first, so no task gets all its rows."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = range_partitions(rows.sparkSession)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    first = dealt.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top).drop("_part")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, share: int = 100, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first collocations."""
    chunks = written(dictionary(docs, max_words - 1), "chunks")
    found, totals = phrase_counts(chunks, min_count, max_words, bits)
    best = top_of_language(outermost(scored(found, totals), found, share), top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
