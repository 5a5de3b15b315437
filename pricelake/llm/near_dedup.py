"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct shingles of ``SHINGLE`` words. Documents with equal sets are
one class, so copies cost nothing further. Each class gets a signature of ``HASHES`` MinHash values; each
of ``TREES`` trees reads them in another order, ``DEPTH`` of them as its label. Sorted by label, the
neighbours of a class are those with the longest common prefix: in sparse regions a prefix of
``MIN_DEPTH`` values makes a candidate, in dense ones the order itself puts the longest prefixes side by side, so the
depth follows the region. The first pass takes ``NEIGHBOURS`` on either side in a tree, which bounds its work and joins most.

Trees are sorted in key ranges that split anywhere, also inside a region; the rows at the ends of ranges
meet in a second, small pass. Candidates are confirmed on full sets: first the most alike of each
class, then those that would join different components. Links give connected components.

A region (the classes that share a prefix of ``MIN_DEPTH`` values in a tree) may then still hold several components whose
members never were neighbours. ``rest`` goes on until nothing is left: in each such region all members meet a few
pivots (the one with most links, the smallest, the largest), which are done there and leave it, in rounds until a
round adds no link; classes in regions that still hold several components are joined by a prefix filter on full sets,
every pair across components whose rarest shingles meet.

A pair of similarity 0.85 shares a prefix of 4 in one of 20 trees with a probability over 0.999999, and each pair that
does is compared, or lies in one component by other links.

Defined cases: null and empty texts have empty sets and stand alone; fewer words than a shingle are one
shingle; rows that repeat a ``doc_id`` are one document (links of either text hold for both); a null
``doc_id`` stands alone with a null component; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import distilled, range_partitions, written
from pricelake.llm.components import components

SHINGLE = 5
THRESHOLD = 85
HASHES = 128
TREES = 20
DEPTH = 24
MIN_DEPTH = 4
NEIGHBOURS = 2
#: Bits of the table that tells candidates' texts from others before they are joined: 16 MB at any size.
_BITS = 1 << 27
_DOCS_AT_ONCE = 400


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 62, (1 << 63) - 1, n, dtype=np.uint64) | np.uint64(1)


_WORD = _odd(1, SHINGLE)
_MUL, _XOR = _odd(2, HASHES), _odd(3, HASHES)


def least_equal(values: int, deviations: float, threshold: int) -> int:
    """Equal values below which a pair cannot be similar enough: so many standard deviations below what is expected."""
    p = threshold / 100
    return max(0, int(values * p - deviations * (values * p * (1 - p)) ** 0.5))


def _least_in_label(threshold: int) -> int:
    return least_equal(DEPTH, 4.2, threshold)


def _least_in_signature(threshold: int) -> int:
    return least_equal(HASHES, 5.1, threshold)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles."""
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in split for w in ws), np.uint64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    rolled = np.zeros(len(words), np.uint64)
    for i in range(SHINGLE):
        rolled[: len(words) - i] += words[i:] * _WORD[i]
    rolled = _mix(rolled)
    sets = []
    for n, end in zip(sizes.tolist(), ends.tolist(), strict=True):
        if n >= SHINGLE:
            sets.append(np.unique(rolled[end - n : end - SHINGLE + 1]))
        elif n:
            one = np.uint64(n)
            for w in words[end - n : end]:
                one = _mix(one * _WORD[0] + w)
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES 16-bit values for each set that is not empty, in order."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, HASHES), np.uint16)
    values = np.concatenate(full)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
    out = np.empty((len(full), HASHES), np.uint16)
    for k in range(HASHES):
        least = np.minimum.reduceat((values ^ _XOR[k]) * _MUL[k], starts)
        out[:, k] = _mix(least) & np.uint64(0xFFFF)
    return out


def tree_orders() -> np.ndarray:
    """Which signature values each tree reads, in its order; the first of all trees differ as far as they last."""
    rng = np.random.default_rng(4)
    first = rng.permutation(HASHES)
    rows = []
    for t in range(TREES):
        head = first[[(t * MIN_DEPTH + i) % HASHES for i in range(MIN_DEPTH)]]
        rest = rng.permutation(np.setdiff1d(np.arange(HASHES), head))
        rows.append(np.concatenate([head, rest])[:DEPTH])
    return np.array(rows)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCS_AT_ONCE):
            part = batch.slice(at, _DOCS_AT_ONCE)
            sets = shingle_sets(part.column("text").to_pylist())
            sigs = iter(signatures(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(sigs).byteswap().tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders = tree_orders()
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), ">u2").reshape(-1, HASHES)
        for t, order in enumerate(orders):
            labels = np.ascontiguousarray(sigs[:, order])
            keys = [bytes([t]) + x.tobytes() for x in labels]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column("node"), batch.column("n_shingles")], ["key", "node", "n_shingles"]
            )


def _alike(key: bytes, n: int, other: bytes, m: int, threshold: int, least: int) -> int:
    """Equal values of two labels, 0 if the pair is no candidate."""
    head = 1 + 2 * MIN_DEPTH
    if key[:head] != other[:head] or 100 * min(n, m) < threshold * max(n, m):
        return 0
    a, b = np.frombuffer(key, ">u2", offset=1), np.frombuffer(other, ">u2", offset=1)
    equal = int((a == b).sum())
    return equal if equal >= least else 0


def _neighbours(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b, equal) among sorted rows; and the first and last rows of the range, with b null."""
    out: list[tuple] = []
    last: list[tuple] = []
    seen = 0
    least = _least_in_label(threshold)

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[], [], [], [], []]
        out.clear()
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["a", "b", "equal", "key", "n_shingles"]
        )

    for batch in batches:
        for key, node, n in zip(*(batch.column(c).to_pylist() for c in ("key", "node", "n_shingles")), strict=True):
            for other, before, m in last:
                if before != node and (equal := _alike(key, n, other, m, threshold, least)):
                    out.append((min(node, before), max(node, before), equal, None, None))
            if seen < NEIGHBOURS:
                out.append((node, None, None, key, n))
            seen += 1
            last = [*last, (key, node, n)][-NEIGHBOURS:]
        yield flush()
    for key, node, n in last[max(0, 2 * NEIGHBOURS - seen) :] if seen > NEIGHBOURS else []:
        out.append((node, None, None, key, n))
    yield flush()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCS_AT_ONCE):
            part = batch.slice(at, _DOCS_AT_ONCE)
            sets = shingle_sets(part.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["node", "shingles"]
            )


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets, null for empty ones), signature."""
    schema = "doc_id long, n_shingles long, set_key binary, signature binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_describe, schema)


def plant(classes: DataFrame) -> DataFrame:
    """key (tree and label), node, n_shingles of each class in each tree."""
    return written(classes.select("node", "n_shingles", "signature").mapInArrow(_plant, "key binary, node long, n_shingles long"), "forest")


def candidates(planted: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Distinct pairs a < b of nodes whose labels are neighbours in some tree, and their most equal values."""
    n = range_partitions(planted.sparkSession)
    schema = "a long, b long, equal int, key binary, n_shingles long"
    ranged = planted.repartitionByRange(n, "key", "node").sortWithinPartitions("key", "node")
    found = written(ranged.mapInArrow(partial(_neighbours, threshold=threshold), schema), "neighbours")
    # the ends of ranges: a few rows for each range
    ends = found.where("b IS NULL").select("key", F.col("a").alias("node"), "n_shingles").coalesce(1).sortWithinPartitions("key", "node")
    across = ends.mapInArrow(partial(_neighbours, threshold=threshold), schema)
    pairs = found.unionByName(across).where("b IS NOT NULL")
    return pairs.groupBy("a", "b").agg(F.max("equal").alias("equal"))


def _same(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sa", "sb"))
        same = (x == y).sum(1)
        keep = np.flatnonzero(same >= least)
        kept = batch.select(["a", "b"]).take(pa.array(keep))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(same[keep], pa.int32())], ["a", "b", "same"])


def likely(pairs: DataFrame, classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Candidates whose whole signatures agree enough: a, b, same."""
    sa = classes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    sb = classes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    same = partial(_same, least=_least_in_signature(threshold))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(same, "a long, b long, same int")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the wanted documents and of a few others.

    A table of bits, one for each hash of a wanted doc_id, goes to all tasks: at most _BITS bits,
    whatever the number of documents. So texts are filtered where they are read, not shuffled.
    """
    def bit(column: str):
        return F.pmod(F.xxhash64(column), F.lit(_BITS)) + 1

    bits = wanted.groupBy(F.bitmap_bucket_number(bit("doc_id")).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit("doc_id"))).alias("bits")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumns({"bucket": F.bitmap_bucket_number(bit("doc_id")), "place": F.bitmap_bit_position(bit("doc_id"))})
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.shiftrightunsigned(byte, 0).bitwiseAND(F.call_function("shiftleft", F.lit(1), (F.col("place") % 8).cast("int"))) > 0
    return rows.join(F.broadcast(bits), "bucket").where(held).select("doc_id", "text")


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), sets.withColumnsRenamed({"node": "b", "shingles": "sb"})
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(a, "a").join(b, "b")
        .withColumns({"both": both, "either": F.size("sa") + F.size("sb")})
        .where(100 * F.col("both") >= threshold * (F.col("either") - F.col("both")))
        .select("a", "b")
    )


def links(docs: DataFrame, classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links between nodes (classes of equal sets, named by their smallest doc_id) that join all components."""
    planted = plant(classes)
    pairs = written(likely(candidates(planted, threshold), classes, threshold), "candidates")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = written(texts_of(docs, wanted).mapInArrow(_sets, "node long, shingles array<long>"), "sets")
    best = F.max_by(F.struct("a", "b"), F.struct("same", "a", "b")).alias("pair")
    ends = pairs.withColumn("node", F.explode(F.array("a", "b")))
    nearest = ends.groupBy("node").agg(best).select("pair.*").distinct()
    first = written(confirm(nearest, sets, threshold), "links")
    joined = components(first)
    a, b = joined.withColumnsRenamed({"node": "a", "component": "ca"}), joined.withColumnsRenamed({"node": "b", "component": "cb"})
    apart = pairs.join(a, "a", "left").join(b, "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")
    ).select("a", "b").join(nearest, ["a", "b"], "left_anti")
    found = first.unionByName(written(confirm(apart, sets, threshold), "links"))
    return rest(docs, classes, planted, found, threshold)


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component by the links found and their number of links."""
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    placed = members.join(components(found), "node", "left").join(ends, "node", "left")
    return placed.withColumns({"component": F.coalesce("component", "node"), "degree": F.coalesce("degree", F.lit(0))})


def _mixed(members: DataFrame) -> DataFrame:
    """Regions whose members are of several components, each with its pivots."""
    pivots = F.array(
        F.max_by("node", F.struct("degree", "node")), F.max_by("node", F.struct("n_shingles", "node")), F.min_by("node", F.struct("n_shingles", "node"))
    )
    regions = members.groupBy("region").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.array_distinct(pivots).alias("pivots")
    )
    return regions.where("least <> most").select("region", "pivots")


def _sizes_fit(threshold: int):
    return 100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb")


def _pairs(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def rest(docs: DataFrame, classes: DataFrame, planted: DataFrame, found: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The links found, and those between members of one region that were never neighbours."""
    rows = planted.select(F.substring("key", 1, 1 + 2 * MIN_DEPTH).alias("region"), "node", "n_shingles")
    # with fewer members all pairs of a region have been neighbours
    wide = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NEIGHBOURS + 1).select("region")
    members = _placed(rows.join(wide, "region", "left_semi"), found)
    members = written(members, "members")
    members = written(members.join(_mixed(members).select("region"), "region", "left_semi"), "members")
    if members.isEmpty():
        return found
    texts = texts_of(docs, members.select(F.col("node").alias("doc_id")).distinct())
    sets = written(texts.mapInArrow(_sets, "node long, shingles array<long>"), "sets")
    while True:
        mixed = written(_mixed(members), "mixed")
        if mixed.isEmpty():
            return found
        inside = members.join(mixed.select("region"), "region", "left_semi")
        chosen = mixed.select("region", F.explode("pivots").alias("node"))
        pivots = members.join(chosen, ["region", "node"], "left_semi").select(
            "region", F.col("node").alias("pivot"), F.col("n_shingles").alias("na"), F.col("component").alias("ca")
        )
        met = inside.withColumnRenamed("n_shingles", "nb").join(pivots, "region").where(F.col("ca") != F.col("component")).where(_sizes_fit(threshold))
        met = met.select(*_pairs("pivot", "node")).distinct()
        more = written(confirm(likely(met, classes, threshold), sets, threshold), "links")
        left = inside.join(chosen, ["region", "node"], "left_anti").select("region", "node", "n_shingles")
        added = not more.isEmpty()
        if added:
            found = found.unionByName(more)
            members = written(_placed(left, found), "members")
        else:
            members = written(left.join(inside.select("region", "node", "component", "degree"), ["region", "node"]), "members")
            break
    last = members.join(_mixed(members).select("region"), "region", "left_semi").select("node", "component").distinct()
    met = rare_pairs(last, sets, threshold)
    return found.unionByName(written(confirm(likely(met, classes, threshold), sets, threshold), "links"))


def _shared_at_least(na: str, nb: str, threshold: int):
    """Shingles that two sets of these sizes share at least, if they are similar enough."""
    return F.ceil(threshold * (F.col(na) + F.col(nb)) / (100 + threshold))


def _may_meet(na: str, nb: str, after_a: str, after_b: str, threshold: int):
    """Whether a shingle can be the first that two sets share: it and those that come after it must be enough."""
    return F.least(after_a, after_b) + 1 >= _shared_at_least(na, nb, threshold)


def rare_pairs(nodes: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs a < b of different components that can be similar enough: exact, by a prefix filter with places.

    Of a set of n shingles at least ``threshold`` per cent must be shared, so with all sets in one order of
    shingles, the rarest first, two similar sets meet in the first n less that many plus one. Shingles of one
    set alone fill these places and need no partner. At the first shingle that two sets share, either has only those
    behind it left, so sets whose own shingles come first meet few others, however many hold the shingle. Components
    meet before their members, by the least and most that these have.
    """
    own = sets.join(nodes, "node").select("node", "component", F.size("shingles").alias("n"), F.xxhash64("shingles").alias("set"), "shingles")
    each = own.select("node", "component", "n", "set", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    places = F.expr(f"n - (n * {threshold} + 99) div 100 + 1")
    ranked = each.join(often, "shingle").groupBy("node", "component", "n", "set").agg(
        F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("shared")
    )
    # shingles that no other set has come first and take places
    room = (places - (F.col("n") - F.size("shared"))).cast("int")
    at = F.posexplode(F.slice("shared", F.lit(1), room)).alias("place", "at")
    placed = ranked.where(room > 0).select("node", "component", "n", F.size("shared").alias("held"), at)
    first = written(
        placed.select(F.col("at.shingle").alias("shingle"), "node", "component", "n", (F.col("held") - F.col("place") - 1).alias("after")), "prefixes"
    )
    here = first.groupBy("shingle", "component").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("after").alias("after"))
    several = here.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    here = written(here.join(several.select("shingle"), "shingle", "left_semi"), "held")
    ca, cb = (here.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("component", "least", "most", "after"))) for x in "ab")
    both = ca.join(cb, "shingle").where(
        (F.col("component_a") < F.col("component_b"))
        & (100 * F.col("most_a") >= threshold * F.col("least_b")) & (100 * F.col("most_b") >= threshold * F.col("least_a"))
        & _may_meet("least_a", "least_b", "after_a", "after_b", threshold)
    ).select("shingle", "component_a", "component_b", "least_b", "most_b", "after_b")
    a = first.select("shingle", F.col("component").alias("component_a"), F.col("node").alias("x"), F.col("n").alias("na"), F.col("after").alias("after_x"))
    b = first.select("shingle", F.col("component").alias("component_b"), F.col("node").alias("y"), F.col("n").alias("nb"), F.col("after").alias("after_y"))
    met = both.join(a, ["shingle", "component_a"]).where(
        (100 * F.col("most_b") >= threshold * F.col("na")) & (100 * F.col("na") >= threshold * F.col("least_b"))
        & _may_meet("na", "least_b", "after_x", "after_b", threshold)
    )
    met = met.join(b, ["shingle", "component_b"]).where(_sizes_fit(threshold) & _may_meet("na", "nb", "after_x", "after_y", threshold))
    return met.select(*_pairs("x", "y")).distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id), kept for every document."""
    described = written(describe(docs), "described")
    full = described.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        full.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "classes",
    )
    # a document that is repeated with several texts joins the classes of these texts
    own = full.groupBy("doc_id").agg(F.count_distinct("set_key").alias("sets")).where("sets > 1").select("doc_id")
    node = classes.select("set_key", "node")
    several = full.join(own, "doc_id", "left_semi").join(node, "set_key").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    found = components(links(docs, classes, threshold).unionByName(several))
    named = node.join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    alone = F.when(F.col("set_key").isNull(), F.col("doc_id"))
    return described.join(named, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.coalesce(alone, "component_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce(alone, "component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group, with its own columns."""
    gone = distilled(docs.sparkSession, lambda: near_duplicates(docs, threshold).where("NOT kept").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti")
