"""The registered queries against their SQL, and the pipeline against a brute-force version of its stages."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from pricelake.llm import near_dedup, packing, quality_rules, source_mix
from pricelake.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck, rows_of_duck, rows_of_spark

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    got = rows_of_spark(QUERIES[name](spark, SF_DIR))
    assert difference(got, rows_of_duck(duck(SF_DIR), ORACLES[name])) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "source mix", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, SF_DIR).persist()
        if name == "quality rules":
            good = {r["doc_id"] for r in quality_rules.judge(docs).select("doc_id", "kept").collect() if r["kept"]}
            assert Counter(after.collect()) == Counter(r for r in before if r["doc_id"] in good)
        elif name == "exact dedup":
            last = {r["text"].translate(lower): r["doc_id"] for r in sorted(before, key=lambda r: r["doc_id"])}
            assert Counter(after.collect()) == Counter(r for r in before if last[r["text"].translate(lower)] == r["doc_id"])
        elif name == "near dedup":
            kept = {r["doc_id"] for r in near_dedup.near_duplicates(docs).where("kept").collect()}
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(kept)
        elif name == "source mix":
            copies = Counter({r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in source_mix.mix(docs).documents.where("size > 0").collect()})
            got = Counter(r["doc_id"] for r in after.collect())
            assert got == +copies and max(got.values()) == 2
        else:
            tokens = Counter()
            for r in after.collect():
                tokens[r["doc_id"]] += r["length"]
            whole = {(r["doc_id"], r["doc_tokens"]) for r in after.collect()}
            copies = Counter(r["doc_id"] for r in before)
            assert all(tokens[i] == n * copies[i] for i, n in whole) and set(tokens) == set(copies)
            assert {r["length"] for r in after.collect()} <= {1 << b for b in range(11)}
        if name != "packing":
            assert set(after.columns) == set(docs.columns)
        docs = after.select(*docs.columns) if name != "packing" else after
    assert packing.MAX_LENGTH == 1024
