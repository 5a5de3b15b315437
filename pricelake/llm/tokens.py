"""Token ids of texts by a public tokenizer, with repeated pieces encoded once.

A byte-level tokenizer splits a text before it merges bytes, and never across the place where a
single space follows a character that is not white space. So a text is cut at such spaces, distinct pieces are
encoded once for each worker, and their ids are put together by array indexing. Texts with other
white space than single spaces and line feeds are cut by a pattern that keeps runs of it whole.
The ids are those of encoding the whole text (tests compare them).
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricelake.llm.arrow_text import byte_slices

#: Pieces, and bytes of them, that a worker remembers before it starts anew.
MEMORY = 1_300_000
MEMORY_BYTES = 48_000_000
#: Bytes of text that are encoded at once.
SLICE = 4_000_000
#: Pieces in one call of the tokenizer: its results take much more memory than ids.
_AT_ONCE = 10_000
# White space of the tokenizer's own splitting pattern (Unicode), as a character class.
_SPACE = "\t-\r \x85\xa0  -     　"
_PIECE = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# Texts that need the pattern: marks used below, white space in runs or at the ends, or of another kind.
_IRREGULAR = r"[\x00\x01\x02]|[ \n][ \n]|^[ \n]|[ \n]$|[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_workers: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Encodes texts with the tokenizer of one file; keeps the ids of pieces it has met."""

    def __init__(self, path: str, pieces: int = MEMORY):
        self.pieces = pieces
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # the same steps without special tokens, which are ordinary text here
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None:
            self.plain.normalizer = self.tokenizer.normalizer
        mark = self.tokenizer.encode("\x02", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and mark[0] not in self.tokenizer.encode("a", add_special_tokens=False).ids else None
        # ids of tokens that begin with a space, as byte-level vocabularies write it
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t[:1] == "\u0120"]] = True
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.begin = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, those behind a space first; where each piece's begin, and how many it has."""
        marked = pieces.to_pylist()
        spaced = np.fromiter((p[:1] > "\x02" for p in marked), bool, len(marked))
        sizes = np.zeros(len(marked), np.int64)
        ids, sizes[spaced] = self._encode_spaced([p for p, s in zip(marked, spaced, strict=True) if s])
        others, sizes[~spaced] = self._encode_marked([_piece(p) for p, s in zip(marked, spaced, strict=True) if not s])
        begin = np.zeros(len(marked), np.int64)
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([ids, others]), begin, sizes

    def _encode_spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words behind a space each: they are cut there anyway, and their first ids tell it."""
        texts = [" " + " ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        found = self.plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in found)])
        begin = np.flatnonzero(self.spaced[ids])
        if len(begin) != len(words) or len(begin) and begin[0]:
            return self._encode_marked([" " + w for w in words])
        return ids, np.diff(begin, append=len(ids))

    def _encode_marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any pieces, which go in as the words of few inputs, with a mark behind each."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.mark is None or any("\x02" in w for w in words):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes
        marked = ["\x02"] * (2 * len(words))
        marked[::2] = words
        groups = [marked[i : i + 400] for i in range(0, len(marked), 400)]
        found = self.plain.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        ends = ids == self.mark
        return ids[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def _learn(self, pieces: pa.Array) -> None:
        """Encode new pieces and keep their ids."""
        parts = [self._encode(pieces[i : i + _AT_ONCE]) for i in range(0, len(pieces), _AT_ONCE)]
        before = np.cumsum([0, *(len(p[0]) for p in parts)])
        flat, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
        begin = np.concatenate([p[1] + b for p, b in zip(parts, before[:-1], strict=True)])
        n, used = len(self.known), self.used
        while n + len(pieces) > len(self.begin):
            self.begin, self.size = np.concatenate([self.begin, self.begin]), np.concatenate([self.size, self.size])
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.ids[used : used + len(flat)] = flat
        self.begin[n : n + len(pieces)] = used + begin
        self.size[n : n + len(pieces)] = sizes
        self.used += len(flat)
        self.known = pa.concat_arrays([self.known, pieces])

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces are in the memory; new ones are learned."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        if len(new) and len(self.known) and (len(self.known) + len(new) > self.pieces or self.known.nbytes + new.nbytes > MEMORY_BYTES):
            self.clear()
            return self._places(pieces)
        at = at.to_numpy(zero_copy_only=False).astype(np.float64)
        if len(new):
            at[np.isnan(at)] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(new)
        return at.astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        array = pa.array(texts, pa.large_string())
        irregular = pc.match_substring_regex(array, _IRREGULAR).to_numpy(zero_copy_only=False)
        regular = np.flatnonzero(~irregular & (pc.utf8_length(array).to_numpy() > 0))
        # a mark at the start of a text, and one in place of a line feed, so that each piece tells what is before it
        marked = pc.binary_join_element_wise(pa.scalar("\x01", pa.large_string()), array.take(pa.array(regular)), pa.scalar("", pa.large_string()))
        split = pc.split_pattern(pc.replace_substring(marked, "\n", " \x00"), " ")
        coded = pc.dictionary_encode(split.flatten())
        coded = coded if isinstance(coded, pa.DictionaryArray) else coded.combine_chunks()
        counts = np.zeros(len(texts), np.int64)
        counts[regular] = pc.list_value_length(split).to_numpy()
        order = np.zeros(0, np.int64)
        if len(coded):
            order = self._places(coded.dictionary)[coded.indices.to_numpy()]
        if irregular.any():
            order, counts = self._with_irregular(texts, np.flatnonzero(irregular), order, counts)
        return self._gather(order, counts)

    def _with_irregular(self, texts, at, order, counts):
        cut = {int(i): ["\x02" + p for p in _PIECE.findall(texts[i])] for i in at}
        distinct = list(dict.fromkeys(p for pieces in cut.values() for p in pieces))
        before = len(self.known)
        places = dict(zip(distinct, self._places(pa.array(distinct, pa.large_string())).tolist(), strict=True))
        if len(self.known) < before:  # the memory started anew: encode the batch on its own
            raise MemoryStartedAnew
        parts, done = [], 0
        for i in range(len(texts)):
            if i in cut:
                parts.append(np.fromiter((places[p] for p in cut[i]), np.int64, len(cut[i])))
                counts[i] = len(cut[i])
            elif counts[i]:
                parts.append(order[done : done + counts[i]])
                done += counts[i]
        return (np.concatenate(parts) if parts else order), counts

    def _gather(self, order: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[order].astype(np.int64)
        total = int(sizes.sum())
        ends = np.cumsum(sizes)
        at = np.arange(total) + np.repeat(self.begin[order] - (ends - sizes), sizes)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[at], np.diff(edges)


class MemoryStartedAnew(Exception):
    """The pieces of a batch were forgotten half-way."""


def _piece(marked: str) -> str:
    """What a marked piece stands for: \\x01 starts a text, \\x00 is a line feed, \\x02 precedes a piece as it is."""
    first = marked[:1]
    if first in ("\x01", "\x02"):
        return marked[1:]
    return "\n" + marked[1:] if first == "\x00" else " " + marked


def encode_batch(path: str, texts: list[str], pieces: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts by the worker's encoder for ``path``, which remembers so many pieces."""
    if path not in _workers:
        _workers[path] = PieceEncoder(path)
    encoder = _workers[path]
    encoder.pieces = pieces
    try:
        return encoder.encode(texts)
    except MemoryStartedAnew:
        encoder.clear()
        return encoder.encode(texts)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE):
    """Slices of a batch with at most about so many bytes of text, one row at least; and their texts. Only one slice's texts are Python strings at a time."""
    for part in byte_slices(batch, text, limit):
        yield part, [x or "" for x in part.column(text).to_pylist()]
    pa.default_memory_pool().release_unused()


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer's file is on this machine (workers call it where they run)."""
    import public_tokenizers

    return public_tokenizers.path(name)
