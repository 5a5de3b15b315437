"""Packing by power-of-two decomposition.

A document's ids, with an end id, are cut into pieces whose lengths are powers of two: as many of
``MAX_LENGTH`` as fit, then one for each bit of the rest. Pieces of one length form a bucket, whose
sequences stack without padding, and no sequence holds parts of two documents.

One pass over the texts writes the pieces; each task numbers its pieces of a length, and the counts of tasks
(one row for each task and length) shift these numbers, so nothing is sorted or shuffled.

Defined cases: a null text counts as empty, an empty text is the end id alone; repeated rows are packed
each on its own, with sequences of their own; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import written
from pricelake.llm.tokens import MEMORY, SLICE, encode_batch, slices, tokenizer_path

MAX_LENGTH = 1024
END_ID = 0
_NAMES = ["doc_id", "start", "length", "doc_tokens", "task", "place", "ids"]
_SCHEMA = "doc_id long, start long, length long, doc_tokens long, task int, place long, ids binary"


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two, longest first, that add up to n."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cutter(tokenizer: str, end_id: int, longest: int, slice_bytes: int, memory: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        counts: dict[int, int] = {}
        path = tokenizer_path(tokenizer)
        for batch in batches:
            for part, texts in slices(batch, limit=slice_bytes):
                flat, sizes = encode_batch(path, texts, memory)
                ends = np.cumsum(sizes)
                rows: list[tuple] = []
                for doc, n, end in zip(part.column("doc_id").to_pylist(), sizes.tolist(), ends.tolist(), strict=True):
                    ids = np.append(flat[end - n : end], np.uint32(end_id)).astype("<u4").tobytes()
                    start = 0
                    for length in piece_lengths(n + 1, longest):
                        place = counts.get(length, 0)
                        counts[length] = place + 1
                        rows.append((doc, start, length, n + 1, task, place, ids[4 * start : 4 * (start + length)]))
                        start += length
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)

    return cut


def pack(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = END_ID,
    longest: int = MAX_LENGTH,
    slice_bytes: int = SLICE,
    memory: int = MEMORY,
) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset.

    ``slice_bytes`` of text are encoded at once by a worker that remembers ``memory`` pieces: less of both takes less memory and more
    time, and gives the same rows. Each piece is a sequence; sequence ids count from 0, shortest bucket first, without gaps.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(rows.mapInArrow(_cutter(tokenizer, end_id, longest, slice_bytes, memory), _SCHEMA), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    inside = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inside"))
    # one row for each bucket
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    shorter = W.orderBy("length").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select("length", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("below"))
    first = inside.join(buckets, "length").select("length", "task", (F.col("inside") + F.col("below")).alias("first"))
    # at most 11 rows for each task
    return pieces.join(F.broadcast(first), ["length", "task"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
