"""Prefix-free parsing of word sequences into overlapping chunks, and n-gram counts from the chunks.

A text is cut into pieces at punctuation and into words at white space. Inside a piece a chunk's core ends behind a word
whose two-word window hashes to a trigger, so equal passages give equal chunks wherever they stand; a core without
a trigger ends after ``LONGEST`` words. A chunk is its core and the ``overlap`` words that follow in the piece. An n-gram of
at most overlap + 1 words is counted in the one chunk whose core holds its first word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricelake.llm.arrow_text import byte_slices

#: One in so many two-word windows ends a core.
EVERY = 24
LONGEST = 128
_SPACE, _BREAK = 0x20, 0x0A
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[ord("A") : ord("Z") + 1] += 32
_BYTES[ord("\t")] = _SPACE
_BYTES[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_MIX = np.uint64(0x9E3779B97F4A7C15)


def text_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of texts (null: none), lower-cased A-Z: the words, the text of each, and whether a piece starts there."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(0, np.uint8)
    if texts.buffers()[2] is not None:
        data = _BYTES[np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]]]
    edges = edges - edges[0]
    inside = (data != _SPACE) & (data != _BREAK)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    borders = edges[:-1][np.diff(edges) > 0]
    opens[borders] = inside[borders]  # a text starts anew even without white space before it
    start = np.flatnonzero(opens)
    kept = np.cumsum(inside)
    offsets = np.append(kept[start] - 1, kept[-1] if len(kept) else 0).astype(np.int64)
    packed = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside])) if len(start) else pa.array([], pa.large_string())
    text = np.searchsorted(edges, start, side="right") - 1
    breaks = np.cumsum(data == _BREAK)
    piece = breaks[start] if len(start) else start
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(piece) > 0) | (np.diff(text) > 0)
    return pc.dictionary_encode(packed), text, first


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def core_starts(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where cores start, given where pieces start and the words' hashes."""
    starts = first.copy()
    window = ((hashes[:-1] * _MIX + hashes[1:]) * _MIX) >> np.uint64(40)
    trigger = window % np.uint64(EVERY) == 0
    trigger &= ~first[1:]  # both words of the window in one piece
    starts[2:] |= trigger[:-1]
    at = np.flatnonzero(starts)
    place = np.arange(len(starts)) - np.repeat(at, np.diff(np.append(at, len(starts))))
    return starts | (place % LONGEST == 0)


def spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each span, one span after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


def joined(words: pa.DictionaryArray, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """Each span of words as one text, words joined by a space."""
    picked = words.dictionary.cast(pa.string()).take(words.indices.take(pa.array(spans(begin, length))))
    offsets = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, picked), " ")


def parse(overlap: int):
    """Rows of lang and text to rows of lang, chunk, core (its words before the overlap) and 1."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch):
                words, text, first = text_words(part.column("text"))
                if not len(words):
                    continue
                hashes = word_hashes(words.dictionary)[words.indices.to_numpy()]
                begin = np.flatnonzero(core_starts(first, hashes))
                end = np.append(begin[1:], len(first))
                pieces = np.append(np.flatnonzero(first), len(first))
                piece_end = pieces[np.searchsorted(pieces, begin, side="right")]
                length = np.minimum(end + overlap, piece_end) - begin
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(text[begin])), joined(words, begin, length),
                     pa.array((end - begin).astype(np.int32)), pa.array(np.ones(len(begin), np.int64))],
                    ["lang", "chunk", "core", "n"],
                )

    return chunks


class Bits:
    """A fixed number of bits that tell which phrases may be frequent: none that is gets lost, a few others pass."""

    def __init__(self, size: int, words: np.ndarray | None = None):
        self.size, self.words = size, words

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes ^ (hashes >> np.uint64(31))) * _MIX) >> np.uint64(20)).astype(np.int64) % self.size

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.words is None:
            return np.ones(len(hashes), bool)
        at = self.places(hashes)
        return (self.words[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def phrase_hashes(lang: np.ndarray, *words: np.ndarray) -> np.ndarray:
    out = lang.copy()
    for w in words:
        out = (out ^ w) * _MIX
        out ^= out >> np.uint64(32)
    return out


def frequent_bits(bits: Bits):
    """Rows of lang and phrase to the places of their bits."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = pc.split_pattern(batch.column("phrase").cast(pa.large_string()), " ")
            n = int(pc.list_value_length(parts)[0].as_py())  # phrases of one length
            coded = pc.dictionary_encode(parts.flatten())
            words = word_hashes(coded.dictionary)[coded.indices.to_numpy()].reshape(-1, n)
            lang = _language_hashes(batch.column("lang"))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(bits.places(phrase_hashes(lang, *words.T))))], ["place"])

    return mark


def _language_hashes(lang: pa.Array) -> np.ndarray:
    coded = pc.dictionary_encode(lang)
    return word_hashes(coded.dictionary)[coded.indices.to_numpy()]


def count(lengths: range, frequent_words, frequent_pairs):
    """Rows of lang, chunk, core and n to rows of lang, phrase and n, added up in each slice, for phrases of the lengths (1, 2, or from 3 on).

    The two arguments give a task the bits of frequent words and pairs, or None: phrases with others in them are left out.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "chunk"):
                parts = pc.split_pattern(part.column("chunk").cast(pa.large_string()), " ")
                words = pc.dictionary_encode(parts.flatten())
                size = pc.list_value_length(parts).to_numpy().astype(np.int64)
                ids, vocabulary = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
                chunk = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
                left = size[chunk] - place  # words from here to the chunk's end
                lang = pc.dictionary_encode(part.column("lang"))
                lang_of = lang.indices.to_numpy().astype(np.int64)[chunk]
                hashes, lang_hash = word_hashes(words.dictionary)[ids], word_hashes(lang.dictionary)[lang_of]
                weight = part.column("n").to_numpy()[chunk]
                at = np.flatnonzero(place < part.column("core").to_numpy()[chunk])
                key = lang_of[at] * vocabulary + ids[at]
                good = good_pair = None
                if frequent_words is not None:
                    good = frequent_words().has(phrase_hashes(lang_hash, hashes))
                if frequent_pairs is not None:
                    good_pair = np.zeros(len(ids), bool)
                    pair = phrase_hashes(lang_hash[:-1], hashes[:-1], hashes[1:])
                    good_pair[:-1] = frequent_pairs().has(pair) & (left[:-1] > 1)
                for n in range(1, lengths[-1] + 1):
                    if n > 1:  # lengthen the phrases that are left by a word
                        fits = left[at] >= n
                        fits[fits] &= good_pair[at[fits] + n - 2] if good_pair is not None else good[at[fits] + n - 1] & good[at[fits]]
                        at, key = at[fits], key[fits]
                        key = np.unique(key, return_inverse=True)[1] * vocabulary + ids[at + n - 1]
                    if n not in lengths or not len(at):
                        continue
                    order = np.argsort(key, kind="stable")
                    bounds = np.flatnonzero(np.diff(key[order], prepend=-1))
                    total = np.add.reduceat(weight[at[order]], bounds)
                    sample = at[order[bounds]]
                    yield pa.RecordBatch.from_arrays(
                        [lang.dictionary.take(pa.array(lang_of[sample])).cast(pa.string()), joined(words, sample, np.full(len(sample), n)), pa.array(total)],
                        ["lang", "phrase", "n"],
                    )

    return grams
