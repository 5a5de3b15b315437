"""Hard negatives: for each anchor and positive, the best rows of other labels inside a window of scores.

Scores are exact inner products of scaled integer vectors (``residue_numbers``). Anchors are a stated query set, scored
against all rows in blocks: rows fall into as many groups as there are partitions, anchors into groups of at most ``ANCHORS``, and
each pair of groups is a cell that one task works through, anchors first, then rows in slices. A cell keeps the best few rows of each window
of each anchor, so a task's memory is bounded whatever its rows, and a cell returns at most that many.
One round finds the positives, the windows follow from their scores, and a second round selects inside them.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component take no part, as anchors neither; shorter
vectors count as filled up with zeros, empty ones score 0; equal scores go by smaller id; an anchor id that
comes several times is one anchor, the one with the smallest label, then vector; rows that share an id are each
a row, but none of the anchor's own id is its partner; further columns are ignored; an empty table gives no rows. Scores that could
pass ``residue_numbers.MAX_SCORE`` are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import range_partitions, written
from pricelake.llm.residue_numbers import moduli, products, residues

SCALE = 256
#: Anchors that meet a group of rows at once, and rows in a slice.
ANCHORS = 4096
SLICE = 1024
_NONE = np.iinfo(np.int64).min
_ROWS = "vec_id long, label long, vector binary, norm double, dims int"
_FOUND = "anchor_id long, window int, score long, vec_id long"


def _whole_vectors(scale: int):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = pc.list_value_length(vectors).to_numpy()
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(scale * np.where(np.isfinite(values), values, np.inf))  # null components read as nan
            edges = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.add.reduceat(np.append(~np.isfinite(whole), False), edges[:-1]) * (lengths > 0) > 0
            whole[~np.isfinite(whole)] = 0
            norms = np.add.reduceat(np.append(whole * whole, 0), edges[:-1]) * (lengths > 0)
            kept = np.flatnonzero(~bad)
            small = np.clip(whole, -(1 << 31), (1 << 31) - 1).astype("<i4")  # larger ones fail the check of norms
            packed = [small[edges[i] : edges[i + 1]].tobytes() for i in kept]
            at = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(packed, pa.binary()),
                 pa.array(norms[kept], pa.float64()), pa.array(lengths[kept], pa.int32())],
                ["vec_id", "label", "vector", "norm", "dims"],
            )

    return convert


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector (floor of scale times each component, 32-bit), squared norm and length of the rows that take part."""
    known = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    typed = known.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    return typed.mapInArrow(_whole_vectors(scale), _ROWS)


def _matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    if all(len(v) == 4 * dims for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), dims).astype(np.int64)
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v) // 4] = np.frombuffer(v, "<i4")
    return out


class Cell:
    """The anchors of a cell and the best rows so far of each of their windows."""

    def __init__(self, anchors: list[tuple], dims: int, primes: list[int], same_label: bool, top: int):
        self.ids = np.array([a[0] for a in anchors], np.int64)
        self.labels = np.array([a[1] for a in anchors], np.int64)
        self.residues = residues(_matrix([a[2] for a in anchors], dims), primes)
        n, w = len(anchors), max((len(a[3]) for a in anchors), default=0)
        self.low, self.high = np.zeros((w, n), np.int64), np.full((w, n), _NONE)
        for i, a in enumerate(anchors):
            for k, (low, high) in enumerate(a[3]):
                self.low[k, i], self.high[k, i] = low, high
        self.scores, self.rows = np.full((w, n, top), _NONE), np.full((w, n, top), np.iinfo(np.int64).max)
        self.dims, self.primes, self.same_label, self.top = dims, primes, same_label, top

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: list[bytes]) -> None:
        """Score a slice of rows and keep what belongs to the best."""
        scores = products(self.residues, residues(_matrix(vectors, self.dims), self.primes), self.primes)
        fits = (self.labels[:, None] == labels) == self.same_label
        fits &= self.ids[:, None] != ids
        for k in range(len(self.low)):
            # a row as good as the last of the kept ones may still have a smaller id
            least = np.maximum(self.low[k], self.scores[k, :, -1])
            anchor, row = np.nonzero(fits & (scores >= least[:, None]) & (scores <= self.high[k][:, None]))
            if not len(anchor):
                continue
            value, name = scores[anchor, row], ids[row]
            order = np.lexsort((name, -value, anchor))
            anchor, value, name = anchor[order], value[order], name[order]
            place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
            best = place < self.top
            touched, at = np.unique(anchor[best], return_inverse=True)
            v = np.full((len(touched), self.top), _NONE)
            i = np.full((len(touched), self.top), np.iinfo(np.int64).max)
            v[at, place[best]], i[at, place[best]] = value[best], name[best]
            v, i = np.hstack([self.scores[k, touched], v]), np.hstack([self.rows[k, touched], i])
            # the smallest value cannot be negated; it marks an empty place and comes last anyway
            keep = np.lexsort((i, -np.maximum(v, _NONE + 1)), axis=1)[:, : self.top]
            self.scores[k, touched] = np.take_along_axis(v, keep, 1)
            self.rows[k, touched] = np.take_along_axis(i, keep, 1)

    def found(self) -> pa.RecordBatch:
        window, anchor, place = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[anchor]), pa.array(window.astype(np.int32)),
             pa.array(self.scores[window, anchor, place]), pa.array(self.rows[window, anchor, place])],
            ["anchor_id", "window", "score", "vec_id"],
        )


def _search(dims: int, primes: list[int], same_label: bool, top: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell, anchors before rows."""
        cell, number, waiting = None, None, []
        for batch in batches:
            cells, windows = batch.column("cell").to_numpy(), batch.column("windows")
            starts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                if begin == end:
                    continue
                if cells[begin] != number:
                    if cell is not None:
                        yield cell.found()
                    cell, number, waiting = None, cells[begin], []
                part = batch.slice(begin, end - begin)
                kinds = pc.is_valid(windows.slice(begin, end - begin)).to_numpy(zero_copy_only=False)
                for is_anchor, places in groupby(range(len(kinds)), kinds.__getitem__):
                    at = list(places)
                    rows = part.slice(at[0], len(at))
                    if is_anchor:
                        pairs = [[(w["low"], w["high"]) for w in ws] for ws in rows.column("windows").to_pylist()]
                        waiting += zip(rows.column("vec_id").to_pylist(), rows.column("label").to_pylist(), rows.column("vector").to_pylist(), pairs, strict=True)
                        continue
                    if waiting:
                        cell, waiting = Cell(waiting, dims, primes, same_label, top), []
                    if cell is None:
                        continue
                    for i in range(0, len(at), SLICE):
                        piece = rows.slice(i, SLICE)
                        cell.add(piece.column("vec_id").to_numpy(), piece.column("label").to_numpy(), piece.column("vector").to_pylist())
        if cell is not None:
            yield cell.found()

    return search


def best_rows(anchors: DataFrame, rows: DataFrame, primes: list[int], dims: int, n_anchors: int, same_label: bool, top: int) -> DataFrame:
    """anchor_id, window, score, vec_id, rank: the first ``top`` rows inside each of an anchor's windows.

    ``anchors`` have vec_id, label, vector and windows (array of low and high score), ``rows`` the first three.
    """
    row_groups, anchor_groups = range_partitions(rows.sparkSession), -(-n_anchors // ANCHORS)
    numbers = F.sequence(F.lit(0), F.lit(anchor_groups - 1))

    def cell(group: Column, part: Column) -> Column:
        return (part * anchor_groups + group).cast("long").alias("cell")

    own = anchors.select("vec_id", "label", "vector", "windows", F.pmod(F.xxhash64("vec_id"), F.lit(anchor_groups)).alias("_group"))
    own = own.select("vec_id", "label", "vector", "windows", "_group", F.explode(F.sequence(F.lit(0), F.lit(row_groups - 1))).alias("_part"))
    none = F.lit(None).cast("array<struct<low:long,high:long>>").alias("windows")
    all_rows = rows.select("vec_id", "label", "vector", none, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(row_groups)).alias("_part"))
    all_rows = all_rows.select("vec_id", "label", "vector", "windows", F.explode(numbers).alias("_group"), "_part")
    both = own.unionByName(all_rows).select("vec_id", "label", "vector", "windows", cell(F.col("_group"), F.col("_part")))
    cells = row_groups * anchor_groups
    dealt = both.repartition(cells, "cell").sortWithinPartitions("cell", F.col("windows").isNull())
    found = dealt.mapInArrow(_search(dims, primes, same_label, top), _FOUND)
    order = W.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is between ``low`` and ``high`` percent of the positive's (both included).
    """
    whole = written(whole_vectors(rows, scale), "vectors")
    chosen = whole.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    chosen = written(chosen.select("vec_id", "row.*"), "anchors")
    norm, dims = whole.agg(F.coalesce(F.max("norm"), F.lit(0.0)), F.coalesce(F.max("dims"), F.lit(0))).first()
    n_anchors = max(chosen.count(), 1)
    primes = moduli(dims, int(norm * (1 + 1e-9)) + 1)  # no inner product passes the largest squared norm

    def windows(low: Column, high: Column) -> Column:
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    everything = F.array(windows(F.lit(_NONE + 1), F.lit(-_NONE - 1))).alias("windows")
    best = best_rows(chosen.select("*", everything), whole, primes, dims, n_anchors, True, positives)
    found = written(best.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole numbers n with low * p <= 100 * n <= high * p
    p = F.col("positive_score")
    least = -F.expr(f"({-low} * positive_score - pmod({-low} * positive_score, 100L)) div 100")
    most = F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100L)) div 100")
    ordered = F.array_sort(F.collect_list(F.struct("window", windows(least, most).alias("bounds"))))  # at most ``positives`` of them
    asked = found.where(p.isNotNull()).groupBy("anchor_id").agg(ordered.alias("w")).select(F.col("anchor_id").alias("vec_id"), F.col("w.bounds").alias("windows"))
    best = best_rows(chosen.join(asked, "vec_id"), whole, primes, dims, n_anchors, False, negatives)
    return best.join(found, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
