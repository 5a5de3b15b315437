"""Language mixtures: counts and inference against plain versions, held-out accuracy, awkward rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake.llm import language_mixture as lm

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"
TEXTS = {
    "aa": "banana mañana kabana tamara. Salaam abracadabra! galaxy",
    "bb": "Trygve trylle tryne spyd; skryt gryte blyant fryd 12 lyd",
    "cc": "queue ououe aieue eue ieoue ouieu",
}


def words(text):
    return [w for w in re.split(r"[\W\d_]+", text.lower()) if w]


def plain_counts(docs):
    out = Counter()
    for text, lang in docs:
        for w in words(text or ""):
            bucket, size = lm.trigram_buckets(pa.array([w], pa.large_string()))
            assert size.tolist() == [len(w)]
            out.update((lang, int(b)) for b in bucket)
    return out


def test_trigrams_of_words():
    both = lm.trigram_buckets(pa.array(["añb", "x", "añc"], pa.large_string()))
    assert both[1].tolist() == [3, 1, 3]
    assert both[0][0] == both[0][4] and both[0][1] != both[0][5]  # " añ" twice, "añb" and "añc"
    assert (both[0] < lm.BUCKETS).all() and (both[0] >= 0).all()


def test_counts_equal_plain(spark):
    docs = [(t, lang) for lang, t in TEXTS.items()] * 3 + [(None, "aa"), ("", "bb"), ("1 2 3", "cc")]
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = df.mapInArrow(lm._count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n")).collect()
    assert {(r[0], r[1]): r[2] for r in got} == dict(plain_counts(docs))


def model():
    counts = plain_counts([(t, lang) for lang, t in TEXTS.items()])
    table = np.zeros((lm.BUCKETS, 3))
    for (lang, bucket), n in counts.items():
        table[bucket, sorted(TEXTS).index(lang)] = n
    return lm.Model(sorted(TEXTS), table)


def plain_infer(m, text):
    """The same inference word by word, and over all subsets instead of nested ones."""
    seen = [np.array(m.likelihoods(pa.array([w], pa.large_string())))[0] for w in words(text)]

    def fit(start):
        pi = np.array(start) / sum(start)
        for _ in range(2000):
            drawn = [pi * e / (pi * e).sum() for e in seen]
            pi = sum(drawn) / len(drawn)
        return pi, sum(math.log((pi * e).sum()) for e in seen)

    full = fit([1, 1, 1])[0]
    values = {}
    for s in range(1, 8):
        pi, value = fit([1.0 if s >> k & 1 else 0.0 for k in range(3)])
        values[s] = (value - lm.PENALTY * math.log1p(len(seen)) * (bin(s).count("1") - 1), pi)
    return full, max(values.values(), key=lambda x: x[0])[1]


@pytest.mark.parametrize("text", [
    TEXTS["aa"], TEXTS["bb"] + " " + TEXTS["bb"], " ".join(TEXTS.values()), TEXTS["aa"] * 4 + " " + TEXTS["cc"] * 3, "banana", "tryne ouieu",
])
def test_inference_equals_plain(text):
    m = model()
    full, chosen, n = m.infer(pa.array(["", text, None, "?!"], pa.string()))
    want_full, want_chosen = plain_infer(m, text)
    assert n.tolist() == [0, len(words(text)), 0, 0]
    assert np.abs(full[1] - want_full).max() < 0.03
    assert ((chosen[1] > 0) == (want_chosen > 0)).all() and np.abs(chosen[1] - want_chosen).max() < 0.03
    assert not full[[0, 2, 3]].any() and not chosen[[0, 2, 3]].any()


def test_inference_of_a_text_does_not_depend_on_its_batch():
    m = model()
    texts = [TEXTS["aa"], "tryne ouieu", " ".join(TEXTS.values()), None, "banana", TEXTS["cc"] * 50]
    together = m.infer(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        alone = m.infer(pa.array([t], pa.string()))
        assert np.allclose(alone[0][0], together[0][i]) and np.allclose(alone[1][0], together[1][i])


def test_awkward_rows(spark):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(list(TEXTS.items()) * 4)]
    rows += [(100, None, "aa"), (101, "", None), (102, "12 ... 7", "bb"), (103, TEXTS["bb"], None), (None, TEXTS["cc"], "cc"), (1, TEXTS["bb"], "bb")]
    rows += [(104, " ".join([TEXTS["aa"], TEXTS["bb"]] * 20), None), (105, "banana kabana " * 100_000, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(-1) for c in ("score", "n", "bucket", "held_out", "languages")})
    got = Counter((r["doc_id"], r["held_out"], r["lang_pred"]) for r in lm.identify(df).collect())
    # the mixed text has seven words of one language to nine of the other
    truth = {t: lang for lang, t in TEXTS.items()} | {None: "und", "": "und", "12 ... 7": "und", rows[-2][1]: "bb"}
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows]
    assert got == Counter((i, h, truth.get(t, "aa")) for (i, t, _), h in zip(rows, held, strict=True))
    by_id = {r["doc_id"]: r for r in lm.identify(df).collect()}
    assert [x["lang"] for x in by_id[104]["languages"]] == ["bb", "aa"]
    assert all(abs(x["share"] - 0.5) < 0.15 for x in by_id[104]["languages"])
    assert by_id[100]["score"] == 0 and by_id[105]["score"] > 0.99 and all(0 <= r["score"] <= 1 for r in by_id.values())


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some words", None), (2, None, "en")], SCHEMA)
    assert [tuple(r) for r in lm.identify(df).select("lang_pred", "score").collect()] == [("und", 0.0)] * 2
    assert lm.identify(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = lm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 150 and right >= 0.98 * n
