"""Each operator on small tables with every awkward case, against a plain brute-force version."""

from __future__ import annotations

import hashlib
import re
import struct
import time
import zlib
from collections import Counter
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake.llm import (
    exact_dedup,
    html_text,
    near_dedup,
    packing,
    pii,
    quality_rules,
    source_mix,
    token_files,
    toxicity,
    url_rules,
)
from pricelake.llm.common import shared_folder
from pricelake.llm.components import components
from pricelake.llm.tokens import PieceEncoder, encode_batch, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards mix quartz and jelly near old " \
    "harbour walls under pale evening light before many small boats return with silver fish and salt for markets " \
    "where children trade bright stones against bread apples honey cheese walnuts figs pears plums and warm milk"


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and long texts, copies, repeated rows, odd characters, near copies."""
    near = PROSE.replace("harbour", "harbor")
    texts = [
        PROSE, PROSE.upper(), near, None, "", "   \n\t ", "one two three", "One  two\tthree", "ÀÉ ß İ", "a b c d e",
        "mail me at jo.doe@mail.example.com or 10.0.0.1, 300.1.1.1, +1 (415) 555-2671, 4111 1111 1111 1111 ok 1.2.3.4.5",
        "x" * 5000, ("word " * 3000).strip(), "line one\nline two\nline one\n" * 30, PROSE + "\n" + PROSE, "token = \"0a1b2c3d4e5f60718293\"",
        "\U0001f600 " * 40, "a@b.c_d@e.f ++1 (2) 3456789", "1" * 3000,
    ]
    out = [(i, t, "en", ["s1", None, "s2"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    out += [(0, PROSE, "en", "s1", len(PROSE)), (3, None, "en", "s1", 0), (40, "same id", None, "s3", 7), (40, PROSE, None, "s3", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(-1) for c in ("kept", "fp", "size", "row", "line", "words", "n", "start", "n_words", "p", "taken", "node", "part")}).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def same_rows(df, expected):
    got = Counter(tuple(r) for r in df.collect())
    assert got == Counter(map(tuple, expected))


# -- exact dedup ----------------------------------------------------------------------------


def test_exact_dedup(docs, rows):
    groups: dict[str, list[int]] = {}
    for i, t, *_ in rows:
        groups.setdefault(lowered(t), []).append(i)
    expected = [
        (i, max(g := groups[lowered(t)]), len(g), i == max(g), hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t, *_ in rows
    ]
    for capacity in (1, 4096):  # a directory that doubles, and one bucket
        found = exact_dedup.exact_duplicates(docs, capacity=capacity)
        same_rows(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"), expected)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    same_rows(kept.select("doc_id"), [(e[0],) for e in expected if e[3]])


def test_directory_doubles_only_where_full(docs):
    index = exact_dedup.build_index(docs, capacity=2)
    assert index.depth > 1
    slots = index.directory.collect()
    assert sorted(r["slot"] for r in slots) == sorted(set(r["slot"] for r in slots))
    assert len({r["depth"] for r in slots}) > 1
    held = index.index.groupBy("bucket").count().collect()
    assert max(r["count"] for r in held) <= 2
    assert all(len(r["bucket"]) == r["depth"] for r in slots)


def test_directory_grows_past_the_bits_counted_at_once(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_STEP", 2)
    keys = spark.range(200).select(F.xxhash64("id").alias("hash_key"), F.lit(1).alias("n"))
    directory, depth = exact_dedup.build_directory(keys, capacity=3)
    assert depth > 5
    bits = [format(r["hash_key"] & (1 << 64) - 1, "064b") for r in keys.collect()]
    slots = directory.collect()
    assert all(format(r["slot"], f"0{depth}b").startswith(r["bucket"]) for r in slots) and len({r["slot"] for r in slots}) == len(slots)
    held = Counter(next(r["bucket"] for r in slots if b.startswith(format(r["slot"], f"0{depth}b"))) for b in bits)
    assert max(held.values()) <= 3


def test_texts_are_grouped_where_their_slot_is_owned(spark, monkeypatch):
    data = [(i, f"text {i % 50}" if i % 3 else "hot") for i in range(600)] + [(None, "hot")]
    rows = spark.createDataFrame(data, "doc_id long, norm string").withColumn("hash_key", F.xxhash64("norm"))
    crowded = rows.withColumn("hash_key", F.xxhash64("norm") % 7)  # keys that several texts share
    for limit in (exact_dedup.HOT_KEYS, 5):
        monkeypatch.setattr(exact_dedup, "HOT_KEYS", limit)
        for table, depth in ((rows, 4), (crowded, 0)):
            keys = table.groupBy("hash_key").agg(F.count(F.lit(1)).alias("n"))
            got = exact_dedup.owner_groups(table, keys, depth)
            texts = [t for _, t in data]
            same_rows(got.select("norm", "keep_id", "group_size"), [(t, max(i for i, x in data if x == t and i is not None), texts.count(t)) for t in set(texts)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("hashpartitioning(slot")]
    assert above.count("Exchange") == 1 and "hashpartitioning(slot" in plan and "REPARTITION_BY_NUM" in plan


def test_owners_share_the_texts_evenly(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "51")
    try:
        rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("norm")).withColumn("hash_key", F.xxhash64("norm"))
        got = exact_dedup.owner_groups(rows, rows.select("hash_key", F.lit(1).alias("n")), 6)
        held = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(held) == 20_000 and max(held) < 600  # 5 of 64 slots are 1560


def test_kept_ids_come_from_the_index(docs):
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "Scan parquet" in line]
    assert len(scans) == 2 and "exact-index" in "".join(scans) and "norm" not in plan
    assert ["keep_id" in x for x in scans].count(True) == 1 and "keep_id" in next(x for x in scans if "exact-index" in x)


# -- quality --------------------------------------------------------------------------------


def measures_of(t):
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked)


def test_quality_measures(docs, rows):
    got = quality_rules.judge(docs.select("doc_id", "text", "source"))
    expected = []
    for i, t, *_ in rows:
        m = measures_of(t)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        expected.append((i, *m, failed, not failed))
    same_rows(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), expected)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    same_rows(kept.select("doc_id", "text"), [(i, t) for (i, t, *_), e in zip(rows, expected, strict=True) if e[-1]])


def test_boilerplate_lines(spark):
    unique = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(30)]
    data = [(i, f"{unique[i]}\nClick  HERE now", "en", "s", 0) for i in range(30)]
    data += [(50 + i, "click here now\n" + "click here now\n" * 40, "en", "s", 0) for i in range(2)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["doc_id"]: r for r in quality_rules.judge(df, min_docs=5, max_share=0.1).collect()}
    assert got[0]["removed_words"] == 0  # the first document keeps the line
    assert all(got[i]["removed_words"] == 3 and got[i]["kept"] for i in range(1, 30))
    assert got[50]["removed_words"] == 3 * 41 and got[50]["depleted"] and not got[50]["kept"]
    texts = {r["doc_id"]: r["text"] for r in quality_rules.clean_texts(df, min_docs=5, max_share=0.1).collect()}
    assert texts[1] == unique[1] and texts[0].endswith("Click  HERE now")


# -- mixing ---------------------------------------------------------------------------------


def expected_targets(rows):
    sizes: dict = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, target, left = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        rest = goal - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] >= 2 * sizes[s]]
        if not over:
            return sizes, target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left.discard(s)
        if not left:
            return sizes, target


def test_source_mix(docs, rows):
    sizes, target = expected_targets(rows)
    source = {i: s for i, _, _, s, _ in rows}
    mixed = source_mix.mix(docs).documents
    got = [r.asDict() for r in mixed.collect()]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    taken: Counter = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3 * source_mix.BLOCK_WORDS
    again = source_mix.mix(docs.repartition(7)).documents
    same_rows(again.select("doc_id", "size", "taken"), [(r["doc_id"], r["size"], r["taken"]) for r in got])
    out = source_mix.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0


def test_slot_points_are_exact_far_out(spark):
    line, mask = 3 * 10**14 + 7, (1 << 62) - 1
    for first in (0, 5 * 10**12, (1 << 61) + 3):
        slots = spark.range(first, first + 2000)
        got = {r["id"]: r["at"] for r in slots.select("id", source_mix.slot_point(F.col("id"), line).alias("at")).collect()}
        assert got == {i: (i * source_mix.GOLDEN & mask) * line >> 62 for i in range(first, first + 2000)}
        ordered = sorted(got.values())
        gaps = [b - a for a, b in zip(ordered, ordered[1:], strict=False)]
        assert min(gaps) > line / 2000 / 4 and max(gaps) < line / 2000 * 4  # as even as the first slots
    assert source_mix.GOLDEN / 2**62 == pytest.approx((5**0.5 - 1) / 2, abs=1e-15)


# -- near dedup -----------------------------------------------------------------------------


def shingles(t):
    w = WORD.findall(lowered(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_dedup(spark, docs, rows):
    data = [*rows]
    words = PROSE.split()
    for k in range(60):  # a chain and a star of near copies
        w = list(words)
        w[k % len(w)] = f"edit{k % 7}"
        data.append((100 + k, " ".join(w), "en", "s", 0))
    ids = sorted({r[0] for r in data})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(r[0], shingles(r[1])) for r in data]
    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(spark.createDataFrame(data, SCHEMA))
    expected = [(i, len(s), root(i) if s else i, i == (root(i) if s else i)) for i, s in sets]
    same_rows(got, expected)
    kept = near_dedup.drop_near_duplicates(docs)
    assert set(kept.columns) == set(docs.columns)


def brute_components(texts):
    """The smallest linked doc_id of each document, by all pairs of full sets."""
    texts = dict(sorted(texts.items()))
    sets = near_dedup.shingle_sets(list(texts.values()))
    sizes = np.array([len(s) for s in sets])
    seen, place = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros((len(sets), len(seen)), np.float32)
    held[np.repeat(np.arange(len(sets)), sizes), place] = 1
    both = (held @ held.T).astype(np.int64)
    alike = 100 * both >= 85 * (sizes[:, None] + sizes[None, :] - both)
    ids = list(texts)
    named = np.arange(len(ids))
    while True:
        least = np.where(alike, named[None, :], len(ids)).min(1)
        if (least == named).all():
            return {d: ids[c] for d, c in zip(ids, named.tolist(), strict=True)}
        named = least


def edited(words, rng, edits, name):
    """The words with some replaced, at least five places apart: five shingles each."""
    out = list(words)
    for i in rng.choice(len(words) // 6 - 1, edits, replace=False):
        out[6 * i + 5] = f"{name}x{i}"
    return out


def test_near_dedup_of_a_star_of_unlike_variants(spark):
    """An original and 1000 variants that are like it (0.860) and less like each other; pairs among others of a template."""
    rng = np.random.default_rng(7)
    original = [f"w{i}" for i in range(404)]
    texts = {500: " ".join(original)}
    for k in range(1000):
        texts[k if k < 500 else k + 1] = " ".join(edited(original, rng, 6, f"v{k}"))
    template = [f"t{i}" for i in range(404)]
    for k in range(80):
        one = edited(template, rng, 9, f"a{k}")
        texts[2000 + 2 * k] = " ".join(one)
        texts[2001 + 2 * k] = " ".join(edited(one, rng, 6, f"b{k}"))
    expected = brute_components(texts)
    assert len({expected[d] for d in range(1001)}) == 1 and len(set(expected.values())) == 81
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == expected


def test_rare_pairs_hold_all_alike_pairs(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(204)]
    texts = [" ".join(edited(words, rng, int(rng.integers(1, 9)), f"v{k}")) for k in range(120)]
    sets = near_dedup.shingle_sets(texts)
    alike = {
        (i, j) for i, a in enumerate(sets) for j in range(i + 1, len(sets))
        if 100 * (both := len(np.intersect1d(a, sets[j]))) >= 85 * (len(a) + len(sets[j]) - both)
    }
    table = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "node long, shingles array<long>")
    nodes = spark.createDataFrame([(i, i % 50) for i in range(len(sets))], "node long, component long")
    got = {(r["a"], r["b"]) for r in near_dedup.confirm(near_dedup.rare_pairs(nodes, table), table).collect()}
    assert got == {(i, j) for i, j in alike if i % 50 != j % 50} and got


def test_rare_pairs_of_unlike_variants_are_few(spark):
    """Variants of one template that are no pairs do not meet each other, however many hold its shingles."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(404)]
    texts = [" ".join(edited(words, rng, 9, f"v{k}")) for k in range(150)]  # 45 of 400 shingles their own
    texts.append(texts[0].replace("w0 ", "one "))
    sets = near_dedup.shingle_sets(texts)
    table = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "node long, shingles array<long>")
    nodes = spark.createDataFrame([(i, i) for i in range(len(sets))], "node long, component long")
    got = {(r["a"], r["b"]) for r in near_dedup.rare_pairs(nodes, table).collect()}
    assert (0, 150) in got and len(got) < 150


def test_near_dedup_threshold_holds_for_sizes_and_counts(spark):
    assert near_dedup._least_in_label(85) == 13 and near_dedup._least_in_signature(85) == 88
    words = [f"w{i}" for i in range(404)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:332]))], "doc_id long, text string")  # 328 of 400
    for threshold, second in ((80, 1), (85, 2)):
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, threshold).collect()}
        assert got == {1: 1, 2: second}


def test_components(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 3000), (5, 900)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[900] == 0
    assert got[3000] == got[2000] == got[1000] == 1000


# -- tokens ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_piecewise_ids_equal_whole_texts(whole, rows):
    rng = np.random.default_rng(1)
    bits = ["a", "The", " ", "  ", "\n", "\n\n", " \n", "\t", "\x00", "\x01", "\x02", "é", "中文", "'s", "don't", "12", "...", "<|endoftext|>", "\xa0", " ", "!?"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 15))) for _ in range(3000)] + [r[1] or "" for r in rows]
    ids, sizes = encode_batch(tokenizer_path(), texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole(texts)


def test_words_behind_a_space_are_encoded_without_marks(monkeypatch):
    words = [f"w{i} é{i}" if i % 9 else f"\x03{i}<|endoftext|>" for i in range(3000)]
    encoder, marked = PieceEncoder(tokenizer_path()), []
    kept = encoder._encode_marked
    monkeypatch.setattr(encoder, "_encode_marked", lambda found: marked.extend(found) or kept(found))
    texts = [" ".join(words), "one\ntwo " + words[0]]
    ids, sizes = encoder.encode(texts)
    expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(expected, []) and sizes.tolist() == [len(x) for x in expected]
    assert len(marked) < 10


def test_packing(docs, rows, whole):
    got: dict = {}
    pieces = packing.pack(docs).collect()
    for r in pieces:
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    expected = Counter()
    for (i, *_), ids in zip(rows, whole(r[1] or "" for r in rows), strict=True):
        full, at = [*ids, 0], 0
        for n in packing.piece_lengths(len(full)):
            expected[(i, at, n, len(full), struct.pack(f"<{n}I", *full[at : at + n]))] += 1
            at += n
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in pieces) == expected
    assert sorted(r["sequence_id"] for r in pieces) == list(range(len(pieces)))
    by_id = sorted(pieces, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_id] == sorted(r["length"] for r in pieces)


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_piece_lengths(n):
    parts = packing.piece_lengths(n)
    assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 1024 for p in parts) and parts == sorted(parts, reverse=True)


def test_token_files(spark, docs, rows, whole):
    folder = shared_folder(spark, "test-files")
    token_files.write_files(docs, folder, shard_bytes=2000)
    got = token_files.read_files(spark, folder).orderBy("start").collect()
    ids = dict()
    for (i, *_), x in zip(rows, whole(r[1] or "" for r in rows), strict=True):
        ids.setdefault(i, []).append(struct.pack(f"<{len(x) + 1}I", *x, 2))
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows)
    at = 0
    for r in got:
        assert r["start"] == at and bytes(r["ids"]) in ids[r["doc_id"]] and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        at += r["n_tokens"]
    one = token_files.read_files(spark, folder, doc_ids=[12]).collect()
    assert [(r["doc_id"], bytes(r["ids"])) for r in one] == [(12, ids[12][0])]


# -- tables in the shared folder ------------------------------------------------------------


def test_stages_leave_small_tables_only(spark, docs, rows):
    more = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    base = Path(shared_folder(spark, "x").removeprefix("file:")).parent
    stages = {
        "verdicts": lambda: quality_rules.keep_good(more),
        "copies": lambda: exact_dedup.drop_duplicates(more),
        "near-copies": lambda: near_dedup.drop_near_duplicates(more),
    }
    for name, stage in stages.items():
        before = set(base.iterdir()) if base.exists() else set()
        out = stage()
        left = set(base.iterdir()) - before
        assert [f.name.rpartition("-")[0] for f in left] == [name]
        columns = spark.read.parquet(str(*left)).columns
        assert not {"text", "_row", "norm", "signature"} & set(columns)
        assert out.columns == docs.columns and out.count() > 0  # still to be read


# -- personal data --------------------------------------------------------------------------


def base_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        n = [int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(s))]
        return sum(n) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, t or "") if ok(m[0])]


def test_pii_base_spans_stay(spark, rows):
    odd = ["\U0001f600 a@b.co 1.1.1.1", "a@b.c_d@e.f-g.h", "1-1 1-1 1-1", "+1((((((2", "0000255.1.1.1 1.1.1.1.1.1.1.1", "..%@a.b@c.d", "é" * 300 + " 4111-1111-1111-1111"]
    many = " ".join(f"{i}.1.1.1 x{i}@y.zz" for i in range(600))
    data = [*rows, *((200 + i, t, "en", "s", 0) for i, t in enumerate([*odd, many]))]
    got = pii.find(spark.createDataFrame(data, SCHEMA)).select("doc_id", pii.span_text(F.col("base")), pii.span_text(F.col("spans"))).collect()
    assert Counter((r[0], r[1]) for r in got) == Counter((i, ",".join(base_spans(t))) for i, t, *_ in data)
    assert all(not r[1] or set(r[1].split(",")) <= set(r[2].split(",")) for r in got)


def test_pii_adds_secrets_and_leaves_prose(spark):
    rng = np.random.default_rng(2)
    key = lambda: "".join(rng.choice(list("0123456789abcdef"), 24))
    data = [(i, f"{PROSE} password={key()} and mail a{i}@b.example.com", "en", "s", 0) for i in range(120)]
    data += [(200 + i, f"{PROSE} in {1900 + i} there were {i * 1000} boats", "en", "s", 0) for i in range(120)]
    df = pii.find(spark.createDataFrame(data, SCHEMA))
    got = {r["doc_id"]: r["spans"] for r in df.collect()}
    assert all([s["kind"] for s in got[i]] == ["email", "secret"] for i in range(120))
    assert not any(got[200 + i] for i in range(120))
    text = spark.createDataFrame(data, SCHEMA).join(df, "doc_id").where("doc_id = 3").select(pii.redact(F.col("text"), F.col("spans"))).first()[0]
    assert text == f"{PROSE} password=<secret> and mail <email>"


def test_pii_learns_from_every_candidate(spark):
    def texts(first, n, text):
        rows = spark.range(first, first + n).withColumnRenamed("id", "doc_id")
        return rows.select("doc_id", text.alias("text"))

    i = F.col("doc_id")
    phones = texts(0, 12_000, F.format_string("call +1 415 555 %04d now", i % 10_000))
    plain = texts(20_000, 12_000, F.format_string("there were %08d boats", i))
    keys = texts(50_000, 2000, F.concat(F.lit("password=7"), F.translate(F.md5(i.cast("string")), "0123456789", "ghijklmnop")))
    found = pii.extract(keys).select("doc_id", F.explode("candidates").alias("c")).where("c.kind = 'secret'").select("doc_id", "c.*")
    # secrets whose hashes are larger than those of 20,000 others
    late = found.where(F.xxhash64("text", "before", "kind", "doc_id", "start") > 7 * 10**18).select("doc_id")
    docs = phones.union(plain).union(keys.join(late, "doc_id")).persist()
    got = pii.find(docs).where("doc_id >= 50000").select("doc_id", F.col("spans.kind").alias("kinds")).collect()
    assert len(got) > 100 and all(r["kinds"] == ["secret"] for r in got)
    rows = pii.extract(docs).select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*")
    counts = pii.counted(rows)
    assert counts.agg(F.sum("n")).first()[0] == rows.count() > 20_000 and counts.count() < 2000
    model, _ = pii.fit(rows)
    assert "<=" not in model.toDebugString  # splits are cuts, none is searched for


# -- toxicity -------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    words, bad = PROSE.split(), ["vilefoo", "vilebar", "vilequx"]
    data, labels = [], []
    for i in range(900):
        w = list(rng.choice(words, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(int(rng.integers(0, len(w))), str(rng.choice(bad)))
        data.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    data += [(2000, None, "en", "s", 0), (2001, "", "en", "s", 0), (2002, "vilefoo " * 30_000, "en", "s", 0), (0, data[0][1], "en", "s", 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(spark.createDataFrame(data, SCHEMA), table).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in data)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in test) >= 0.98 * len(test)
    texts = {d[0]: d[1] for d in data}
    found = [texts[r["doc_id"]][s["start"] : s["end"]] for r in test for s in r["spans"]]
    assert found and sum(x.startswith("vile") for x in found) >= 0.95 * len(found)
    one_kind = toxicity.score(spark.createDataFrame(data, SCHEMA), table.where("toxic = 0")).collect()
    assert {r["score"] for r in one_kind} == {0.0}


def test_marginals_against_all_tag_sequences():
    rng = np.random.default_rng(5)
    e, move = rng.normal(size=7), rng.normal(size=(2, 2))
    total, marked = 0.0, np.zeros(7)
    for tags in np.ndindex(*[2] * 7):
        weight = np.exp(sum(e[i] for i in range(7) if tags[i]) + sum(move[a, b] for a, b in zip(tags, tags[1:], strict=False)))
        total += weight
        marked += weight * np.array(tags)
    counts = np.array([0, 7, 0])
    assert toxicity.marginals(e, counts, move) == pytest.approx(marked / total)


# -- pages ----------------------------------------------------------------------------------


def test_url_rules(spark):
    cases = [
        ("http://Example.ORG/es/1?x#y", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("https://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
        ("https://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
        ("https://x.com/DE/a", "x.com", "/DE/a", None, "allow"),
        ("https://www.cheap-pills.com/en/", "www.cheap-pills.com", "/en/", None, "block"),
        ("https://org", "org", "", None, "allow"),
        ("https://x.net?q=/de/", "x.net", "", None, "allow"),
        ("http://a\nb.org/x", "a\nb.org", "/x", "org/", "allow"),
        ("http://a\nb.com/de/", "a\nb.com", "/de/", "com/de/", "block"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    data = [(i, c[0], "clash", 1) for i, c in enumerate(cases)] + [(0, cases[0][0], "clash", 1)]
    df = spark.createDataFrame(data, "page_id long, url string, host string, verdict int")
    got = url_rules.judge(df).select("page_id", "host", "path", "rule", "verdict")
    same_rows(got, [(i, *c[1:]) for i, c in [*enumerate(cases), (0, cases[0])]])
    index = url_rules.index_rules(url_rules.PLACES, {t: n for n, t in enumerate(sorted({t for r in url_rules.PLACES for t in r.tokens}))})
    assert sum(map(len, index.values())) == len(url_rules.PLACES)


def test_html_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><nav><a>menu</a></nav>"
        "<div class='ad'>buy</div><article><header>by me</header><h1>Head &amp; tail</h1><p><b>first<br><p>second\n line &eacute;</p>"
        "<div class=\"related-posts\">more</div><form>name</form><div id='comments'><p>I think</p></div><ul><li>a<li>b</ul></article>"
        "<aside>side</aside><footer>&copy;</footer>"
    )
    plain = "<body><div class='top'>Same on all pages</div><div id=main><p>Text {0}</p><p>and {0}</p></div></body>"
    data = [(0, "http://h/1", page, 1), (1, None, None, 1), (2, "http://h/2", "", 1), (3, "x", "a < b && c &lt; d", 1), (0, "http://h/1", page, 1)]
    data += [(10 + i, f"http://other/{i}", plain.format(i), 1) for i in range(8)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, host int")
    got = html_text.main_text(df).collect()
    text = "Head & tail\nfirst\nsecond line é\na\nb"
    expected = [(0, text), (0, text), (1, ""), (2, ""), (3, "a < b && c < d")] + [(10 + i, f"Text {i}\nand {i}") for i in range(8)]
    assert Counter((r["page_id"], r["text"]) for r in got) == Counter(expected)
    assert unescape("&eacute;") == "é"


def test_html_text_counts_distinct_pages(spark):
    page = "<html><body><div class='top'>Top</div><div class='box'><p>{0}</p></div></body></html>"
    data = [(i, f"http://equal/{i}", page.format("same"), 1) for i in range(5)]
    data += [(100 + i, f"http://hot/{i}", page.format("copy" if i < 90 else f"text {i}"), 1) for i in range(100)]
    data += [(300 + i, f"http://wrap/{i}", f"<html><body><div class='box'>{'one' if i < 60 else 'two'}<!-- {i} --></div></body></html>", 1) for i in range(61)]
    got = html_text.main_text(spark.createDataFrame(data, "page_id long, url string, html string, host int")).collect()
    expected = [(i, "Top\nsame") for i in range(5)] + [(100 + i, "copy" if i < 90 else f"text {i}") for i in range(100)]
    expected += [(300 + i, "one" if i < 60 else "two") for i in range(61)]
    assert Counter((r["page_id"], r["text"]) for r in got) == Counter(expected)


def text_of(html):
    out = html_text._extract(iter([pa.RecordBatch.from_pydict({"page_id": [1], "url": ["u"], "html": [html], "low": [None]}, schema=pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("low", pa.list_(pa.int64()))]))]))
    return next(out).column("text")[0].as_py()


@pytest.mark.parametrize("html, text", [
    ("<p title=it's ok>Hello</p><p title='a>b' x=\"c>d\">you</p>", "Hello\nyou"),
    ("<form id=aspnet><div><article><p>In a form</p></article></div><input></form>", "In a form"),
    ("<div>x</div><form>Name<input></form>", "x"),
    ("<body><article class='post share'><p>Named</p><nav>menu</nav></article></body>", "Named"),
    ("<main class=search-page><p>Main</p></main>", "Main"),
    ("<p>one</p><a href=\"open>two</a><p>three</p>", "one\ntwo\nthree"),
    ("a<!-- x > y -->b<!--> c<!doctype html><?php x ?>d</ e", "ab cd</ e"),
    ("<textarea>no</textarea><title>no</title >yes<script>'</scripty>'</script\n>!", "yes!"),
    ("<table><tr><td>1<td>2<tr><td>3</table><ul><li>a<ul><li>b</ul><li>c</ul><dl><dt>t<dd>u</dl>", "1\n2\n3\na\nb\nc\nt\nu"),
    ("<div><article><p>in</div></span>side</article>out</div>", "inside"),
])
def test_html_markup(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("html", [
    "<a " * 100_000, "<a x='" * 50_000, "<a x=\">'" * 50_000, "<div>" * 50_000 + "</b>" * 50_000, "<b>" * 50_000 + "<hr>" * 50_000 + "end",
    "<div><article>" + "<b>" * 50_000 + "</div>" * 50_000, "<script>" + "</script " * 50_000, "<ul>" + "<b>" * 50_000 + "<li>" * 50_000,
    "<p>" + "a &amp; b " * 200_000, "<!--" * 100_000, "<a b" + " " * 200_000 + "c" * 200_000 + ">x", "<form>" * 30_000 + "<main>" * 30_000,
])
def test_html_of_any_shape_is_read_in_proportional_time(html):
    begun = time.perf_counter()
    root = html_text.parse(html)
    html_text.branches(root), html_text._holders([root]), text_of(html)
    assert time.perf_counter() - begun < 6


def test_html_text_of_a_hot_host_in_parts(spark, monkeypatch):
    page = "<body><div class='top'>Same on all pages</div><div><p>Text {0}</p></div></body>"
    data = [(i, f"http://{'hot' if i < 80 else f'h{i % 2}'}/{i}", page.format(i), 1) for i in range(100)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, part int")
    for hosts in (4, 1024):
        monkeypatch.setattr(html_text, "HOT_HOSTS", hosts)
        got = html_text.main_text(df).collect()
        assert sorted((r["page_id"], r["text"]) for r in got) == [(i, f"Text {i}") for i in range(100)]


def test_html_text_drops_repeated_blocks_inside_main(spark):
    page = (
        "<body><main><div class='box'>same on all pages</div><article><h2>About</h2><p>Text <b>bold</b><br>of {0}</p>"
        "<div class='slot'><p>Same too</p></div><table><tr><td>Price<td>{0}</table></article></main></body>"
    )
    data = [(i, f"http://h/{i}", page.format(i), 1) for i in range(8)]
    data += [(20 + i, "http://few/1", page.format(i), 1) for i in range(2)]
    got = html_text.main_text(spark.createDataFrame(data, "page_id long, url string, html string, host int")).collect()
    expected = [(i, f"About\nText bold\nof {i}\nPrice\n{i}") for i in range(8)]
    expected += [(20 + i, f"same on all pages\nAbout\nText bold\nof {i}\nSame too\nPrice\n{i}") for i in range(2)]
    assert Counter((r["page_id"], r["text"]) for r in got) == Counter(expected)


# -- empty tables ---------------------------------------------------------------------------


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_folder(spark, "test-empty")
    token_files.write_files(empty, folder)
    for df in (
        exact_dedup.exact_duplicates(empty), exact_dedup.drop_duplicates(empty), quality_rules.judge(empty), quality_rules.keep_good(empty),
        source_mix.mix(empty).documents, source_mix.mixed_documents(empty), near_dedup.near_duplicates(empty), packing.pack(empty),
        token_files.read_files(spark, folder), pii.find(empty), toxicity.score(empty, labels), url_rules.judge(pages), html_text.main_text(pages),
    ):
        assert df.count() == 0
