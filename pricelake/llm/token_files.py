"""Token-id files: documents compressed one by one with a shared dictionary.

A zstandard dictionary is trained on the id arrays of at most ``SAMPLE`` documents. Documents are dealt into ranges
of doc_id and encoded in ascending order; each is a zstandard frame of its ids (16 or 32 bits wide),
with an end id. Frames are gathered into shards of about ``SHARD_BYTES``:

    magic "PLTK", version, width of an id in bytes, number of documents (32 bits)
    SHA-256 of the dictionary
    per document: doc_id (64 bits), null flag, end of its frame (64 bits), number of ids (32 bits)
    the frames

Shards are rows of a Parquet table with the range of doc_ids they hold, so a writer's commit is Spark's, any shared
file system serves, and one short document costs one shard and one frame. The dictionary lies beside them.

Defined cases: a null text counts as empty, an empty text is the end id alone; equal doc_ids are ordered by a hash
of the text, repeated rows stand one after another; null doc_ids come first; further columns are ignored; an
empty table gives files without documents.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import range_partitions, running_offsets
from pricelake.llm.tokens import encode_batch, slices, tokenizer_path

END_ID = 2
#: Documents that the dictionary is trained on, those with the smallest hashes of doc_id.
SAMPLE = 2000
#: Bytes of ids that one sampled document gives to the training of the dictionary, its first; all are written.
SAMPLE_BYTES = 131_072
DICTIONARY_BYTES = 65_536
SHARD_BYTES = 4_000_000
LEVEL = 3
MAGIC, VERSION = b"PLTK", 1
_HEAD = "<4sBBI32s"
_ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("end", "<u8"), ("n", "<u4")])
_SHARD = "task int, shard int, first_doc long, last_doc long, n_docs long, n_tokens long, payload binary"


def _encoder(tokenizer: str, end_id: int, width: int):
    """Batches of (doc_id, text) to batches of (doc_id, ids as bytes of the given width, number)."""

    def encode(batches: Iterator[pa.RecordBatch]):
        path = tokenizer_path(tokenizer)
        for batch in batches:
            for part, texts in slices(batch):
                flat, sizes = encode_batch(path, texts)
                flat, ends = flat.astype(f"<u{width}"), np.cumsum(sizes)
                last = np.array([end_id], f"<u{width}").tobytes()
                for doc, n, end in zip(part.column("doc_id").to_pylist(), sizes.tolist(), ends.tolist(), strict=True):
                    yield doc, flat[end - n : end].tobytes() + last, n + 1

    return encode


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int, sample: int = SAMPLE) -> bytes:
    """The shared dictionary; empty where there are too few documents to train one."""
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    n = max(1, docs.count())
    share = min(1 << 30, (1 << 30) * 4 * sample // n)  # enough rows for the sample, few for the sort
    chosen = docs.where(order < share).select("doc_id", "text", order.alias("h"), F.xxhash64("text").alias("t"))
    chosen = chosen.orderBy("h", "t").limit(sample).select("doc_id", "text")
    encode = _encoder(tokenizer, end_id, width)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [ids[:SAMPLE_BYTES] for _, ids, _ in encode(batches)]
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
        except zstandard.ZstdError:
            data = b""
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["dictionary"])

    rows = chosen.coalesce(1).mapInArrow(train, "dictionary binary").collect()  # one row of bounded size
    return bytes(rows[0]["dictionary"]) if rows else b""


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _shard_writer(tokenizer: str, end_id: int, width: int, dictionary: bytes, shard_bytes: int):
    encode, digest = _encoder(tokenizer, end_id, width), hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, shard, pack = TaskContext.get().partitionId(), 0, _compressor(dictionary)
        frames: list[bytes] = []
        entries: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            head = struct.pack(_HEAD, MAGIC, VERSION, width, len(entries), digest)
            payload = b"".join([head, np.array(entries, _ENTRY).tobytes(), *frames])
            known = [e[0] for e in entries if not e[1]]
            row = (task, shard, min(known, default=None), max(known, default=None), len(entries), sum(e[3] for e in entries), payload)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in _SHARD.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for doc, ids, n in encode(batches):
            frame = pack.compress(ids)
            size += len(frame)
            frames.append(frame)
            entries.append((doc or 0, doc is None, size, n))
            if size >= shard_bytes:
                yield close()
                shard, frames, entries, size = shard + 1, [], [], 0
        if entries:
            yield close()

    return write


def write_files(
    docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID,
    vocabulary: int = 50_257, shard_bytes: int = SHARD_BYTES,
) -> None:
    """Write the documents' ids to ``folder``."""
    spark = docs.sparkSession
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(rows, tokenizer, end_id, width)
    about = [(dictionary, hashlib.sha256(dictionary).hexdigest(), tokenizer, width, end_id)]
    spark.createDataFrame(about, "dictionary binary, sha256 string, tokenizer string, width int, end_id int").write.parquet(f"{folder}/dictionary")
    ordered = rows.withColumn("_tie", F.xxhash64("text"))
    dealt = ordered.repartitionByRange(range_partitions(spark), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    shards = dealt.select("doc_id", "text").mapInArrow(_shard_writer(tokenizer, end_id, width, dictionary, shard_bytes), _SHARD)
    shards.write.option("compression", "uncompressed").parquet(f"{folder}/shards")


def _shard_reader(dictionary: bytes, wanted: frozenset[int] | None):
    digest = hashlib.sha256(dictionary).digest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _decompressor(dictionary)
        for batch in batches:
            for task, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("task", "shard", "payload")), strict=True):
                magic, version, width, n, of = struct.unpack_from(_HEAD, payload)
                if (magic, version) != (MAGIC, VERSION) or of != digest:
                    raise ValueError("a shard of another format or dictionary")
                entries = np.frombuffer(payload, _ENTRY, n, struct.calcsize(_HEAD))
                base = struct.calcsize(_HEAD) + entries.nbytes
                begins = np.concatenate([[0], entries["end"][:-1]]).astype(np.int64) + base
                before = np.concatenate([[0], np.cumsum(entries["n"].astype(np.int64))[:-1]])
                rows = []
                for i, (e, at) in enumerate(zip(entries, begins.tolist(), strict=True)):
                    if wanted is not None and (e["null"] or int(e["doc_id"]) not in wanted):
                        continue
                    raw = unpack.decompress(payload[at : base + int(e["end"])])
                    ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                    rows.append((task, shard, None if e["null"] else int(e["doc_id"]), int(before[i]), int(e["n"]), ids, zlib.crc32(ids)))
                    if len(rows) == 2000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    return read


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    names = ["task", "shard", "doc_id", "before", "n_tokens", "ids", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _digest_only(read):
    """Leave the ids in the worker: only their checksum goes on."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read(batches):
            yield batch.drop_columns(["ids"]) if hasattr(batch, "drop_columns") else batch.select([c for c in batch.schema.names if c != "ids"])

    return digests


def read_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and ids of the documents in ``folder``.

    With ``doc_ids`` only shards whose range can hold one are read, and only wanted frames are decompressed.
    """
    about = spark.read.parquet(f"{folder}/dictionary").first()
    shards = spark.read.schema(_SHARD).parquet(f"{folder}/shards")
    starts = running_offsets(shards.select("task", "shard", "n_tokens"), ["shard"], {"shard_start": "n_tokens"}, part="task").drop("n_tokens")
    if doc_ids is not None:
        low, high = min(doc_ids, default=0), max(doc_ids, default=-1)
        shards = shards.where((F.col("last_doc") >= low) & (F.col("first_doc") <= high))
    read = _shard_reader(bytes(about["dictionary"]), None if doc_ids is None else frozenset(doc_ids))
    schema = "task int, shard int, doc_id long, before long, n_tokens long, ids binary, ids_crc32 long"
    if not with_ids:
        read, schema = _digest_only(read), schema.replace(" ids binary,", "")
    rows = shards.select("task", "shard", "payload").mapInArrow(read, schema)
    return rows.join(starts, ["task", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )
