"""Exact scores by residues, and mined negatives against a plain version."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import hard_negatives
from pricelake.llm.residue_numbers import MAX_SCORE, moduli, products, residues

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("dims,size", [(1, 3), (64, 256), (256, 1 << 12), (700, 1 << 19), (3, 1 << 24)])
def test_products_are_exact(dims, size):
    rng = np.random.default_rng(dims)
    a, b = rng.integers(-size, size, (17, dims)), rng.integers(-size, size, (23, dims))
    a[0], b[0], b[1] = size, size, -size  # the largest scores there are
    primes = moduli(dims, dims * size * size)
    assert len(set(primes)) == len(primes) and math.prod(primes) > 2 * dims * size * size
    got = products(residues(a, primes), residues(b, primes), primes)
    assert (got == a.astype(object) @ b.T.astype(object)).all()


def test_scores_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        moduli(8, MAX_SCORE + 1)


def plain(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    known = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        known.append((i, label, [math.floor(scale * x) for x in v]))
    anchors = {}
    for r in sorted(known, key=lambda r: (r[1], np.array(r[2], "<i4").tobytes())):
        if r[0] % 100 == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a, label, v in anchors.values():
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w in known if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(a, i, k + 1, s[1], -p, -s[0]) for k, s in enumerate(hard)]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    out = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)], int(i % 3)) for i in range(420)]
    out += [(1000 + i, out[5][1], i % 4) for i in range(60)]  # one vector many times: ties
    out += [(i, v, label) for i, v, label in out[:30]]  # repeated rows, an anchor among them
    out += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")], 0), (2003, [float("inf"), 1.0], 2), (2100, [1.0, 2.0], None), (None, [1.0], 1)]
    out += [(2200, [], 0), (2201, [], 1), (2300, [3.0, -1.0], 1), (2301, [0.5] * 9, 2), (2400, [-2.0] * 6, 0), (-100, [1.0] * 6, 1)]
    out += [(200, [9.0] * 6, 0)]  # an anchor id with another vector
    return out


@pytest.mark.parametrize("anchors", [4096, 2])
def test_mined_negatives(spark, rows, anchors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(-1) for c in ("windows", "cell", "score", "rank", "vector", "norm", "_group")})
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == plain(rows)


def test_other_windows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, positives=3, negatives=4, low=-50, high=110, scale=1000)
    assert Counter(tuple(r) for r in got.collect()) == plain(rows, 3, 4, -50, 110, 1000)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA)
    assert hard_negatives.mine(alone, F.col("vec_id") % 100 == 0).collect() == []
