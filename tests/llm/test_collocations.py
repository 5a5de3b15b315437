"""Prefix-free parsing and collocations against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake.llm import collocations, prefix_free
from pricelake.llm.prefix_free import Bits, parse, text_words

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    cut = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in cut) if w]


def plain(docs, min_count, max_words, top, share=100):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            totals[lang] += len(p)
            counts[lang].update(tuple(p[i : i + k]) for k in range(1, max_words + 1) for i in range(len(p) - k + 1))
    out = []
    for lang, f in counts.items():
        rows, n = [], totals[lang]
        longer = defaultdict(int)  # largest count of any longer phrase around a phrase
        for q, m in f.items():
            for i in range(len(q)):
                for j in range(i + 1, len(q) + 1):
                    if j - i < len(q):
                        longer[q[i:j]] = max(longer[q[i:j]], m)
        for p, a in f.items():
            if len(p) < 2 or a < min_count or (longer[p] >= min_count and 100 * longer[p] >= share * a):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right, n))
        rows.sort()
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], r[5], -r[0]) for i, r in enumerate(rows[:top])]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["the", "of", "New", "york", "strong", "tea", "é", "ÀB", "a|b", "\x1f", "x\x00y", "　w", "end"] + [f"w{i}" for i in range(30)]
    out = []
    for i in range(150):
        words = rng.choices(vocabulary, [12, 9, 6, 6, 4, 4, 3, 3, 2, 2, 1, 1, 1] + [1] * 30, k=rng.randrange(0, 120))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " \r\n", ":"]) for w in words)
        out.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    out += [(500 + i, "A passage that many documents share, word for word New York", "en") for i in range(40)]
    out += [(900, None, "en"), (901, "", "de"), (902, " \t\n.,", None), (903, "again " * 3000, "en"), (904, " ".join(f"w{i % 30}" for i in range(6000)), "de")]
    return out + out[:10]


def test_words_of_texts(rows):
    texts = pa.array([t for _, t, _ in rows], pa.string())
    for part in (texts, texts.slice(37, 60), texts.slice(0, 0)):
        words, text, first = text_words(part)
        want = [(i, k == 0, w) for i, t in enumerate(part.to_pylist()) for p in pieces(t) for k, w in enumerate(p)]
        assert list(zip(text.tolist(), first.tolist(), words.to_pylist(), strict=True)) == want


@pytest.mark.parametrize("longest", [128, 3, 1])
def test_each_phrase_starts_in_one_core(rows, longest, monkeypatch):
    monkeypatch.setattr(prefix_free, "LONGEST", longest)
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], ["text", "lang"])
    chunks = [c for b in parse(2)(iter([batch])) for c in b.to_pylist()]
    got, want = Counter(), Counter()
    for c in chunks:
        words = c["chunk"].split(" ")
        assert 1 <= c["core"] <= longest and len(words) <= c["core"] + 2
        got.update((c["lang"], *words[i : i + k]) for i in range(c["core"]) for k in (1, 2, 3) if i + k <= len(words))
    for _, t, lang in rows:
        for p in pieces(t):
            want.update((lang, *p[i : i + k]) for k in (1, 2, 3) for i in range(len(p) - k + 1))
    assert got == want


def test_equal_passages_give_equal_chunks():
    passage = " ".join(f"p{i}" for i in range(300))
    texts = [f"{' '.join(['lead'] * k)} {passage}" for k in (1, 5, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 3)], ["text", "lang"])
    chunks = Counter(c["chunk"] for b in parse(4)(iter([batch])) for c in b.to_pylist())
    assert sum(n == 3 for n in chunks.values()) >= 8 and sum(n < 3 for n in chunks.values()) <= 6


def test_bits_lose_nothing():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    bits = Bits(1 << 16)
    table = np.zeros(1 << 13, np.uint8)
    for p in bits.places(hashes).tolist():
        table[p >> 3] |= 1 << (p & 7)
    full = Bits(1 << 16, table)
    assert full.has(hashes).all() and full.has(rng.integers(0, 1 << 63, 1000).astype(np.uint64)).mean() < 0.1


@pytest.mark.parametrize("min_count,max_words,top,share,bits", [(5, 5, 2000, 100, 1 << 20), (3, 5, 25, 100, 64), (4, 2, 7, 100, 1 << 20), (4, 3, 2000, 60, 1 << 20)])
def test_collocations(spark, rows, min_count, max_words, top, share, bits):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit(-1) for c in ("n", "chunk", "core", "phrase", "f", "words", "rank")})
    got = Counter(tuple(r) for r in collocations.mine(df, min_count, max_words, top, share, bits).collect())
    assert got == plain(rows, min_count, max_words, top, share)


def test_large_counts_are_exact(spark):
    found = spark.createDataFrame([("en", "a", 1, 3 * 10**15), ("en", "b", 1, 10**15 + 1), ("en", "a b", 2, 10**15)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 7 * 10**17)], "lang string, n long")
    row = collocations.scored(found, totals).first()
    assert row["score"] == 1000 * 10**15 * 7 * 10**17 // (3 * 10**15 * (10**15 + 1))


def test_no_rows(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).collect() == []
