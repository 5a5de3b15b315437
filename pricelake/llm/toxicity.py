"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words are tagged toxic or not. The labels are of documents, so words of the training documents are labelled first:
in a toxic document, those whose form or stem follows at least ``SUPPORT`` different words there and is rare in other documents.
The field (two tags, transitions, features of a word and its stems) is fitted to them; then the toxic documents
are tagged by its own marginals, and it is fitted once more. For each word forward-backward gives the probability of
the toxic tag; a document's score is a logistic function of "some word is toxic" and of the expected number
of toxic words. Chains are windows of ``WINDOW`` words; every word of a text is in one.

The field is fitted in one task on at most ``FIT_DOCS`` labelled documents, those with the smallest hashes; scoring is one
pass over all whole texts, without a shuffle.

Defined cases: null and empty texts score as texts without words; repeated rows score alike; labels that repeat a document count
as toxic if one does; without labels of both kinds all scores are 0; a null ``doc_id`` is not held out; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.tokens import slices

FIT_DOCS = 3000
#: Different words before it that a toxic word's form needs: copies of one text add none.
SUPPORT = 5
#: Natural log of how much more frequent a toxic word's form is in toxic documents.
ODDS = 3.0
WINDOW = 64
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_features(word: str) -> list[str]:
    """A word's form and stems."""
    form = word.lower().strip(_PUNCTUATION)
    return [form, *(f"{form[:n]}-" for n in STEMS if len(form) > n)] if form else []


def split_words(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word number of each word, the distinct words, and how many words each text has."""
    parts = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pa.array(texts, pa.large_string())))
    coded = pc.dictionary_encode(parts.flatten())
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), pc.list_value_length(parts).to_numpy().astype(np.int64)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each window of the texts laid end to end."""
    per = -(-counts // WINDOW)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(counts)), per)
    place = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    return begin[of] + place * WINDOW, np.minimum(WINDOW, counts[of] - place * WINDOW)


def marginals(emission: np.ndarray, counts: np.ndarray, move: np.ndarray, pairs: bool = False):
    """Probability of the toxic tag of each word; with ``pairs`` also the log-likelihood's parts.

    emission: score of the toxic tag of each word, texts laid end to end; move: transition scores [from, to].
    Windows go step by step side by side.
    """
    begin, size = windows(counts)
    order = np.argsort(-size, kind="stable")  # longest first: those still running are a prefix
    begin, size = begin[order], size[order]
    step = np.exp(move - move.max())
    n, longest = len(begin), int(size.max(initial=0))
    running = np.searchsorted(-size, -np.arange(longest), side="left") if n else []
    e = np.exp(np.clip(emission, -30, 30))
    ahead = np.empty((len(emission), 2))
    a = np.full((n, 2), 0.5)
    for t in range(longest):
        k = running[t]
        at = begin[:k] + t
        into = a[:k] @ step if t else a[:k].copy()
        into[:, 1] *= e[at]
        into /= into.sum(1, keepdims=True)
        a[:k] = into
        ahead[at] = into
    p = np.empty(len(emission))
    moved = np.zeros((2, 2))
    b = np.ones((n, 2))
    for t in range(longest - 1, -1, -1):
        k = running[t]
        at = begin[:k] + t
        both = ahead[at] * b[:k]
        both /= both.sum(1, keepdims=True)
        p[at] = both[:, 1]
        if t:
            after = b[:k].copy()
            after[:, 1] *= e[at]
            if pairs:
                joint = ahead[at - 1][:, :, None] * step[None] * after[:, None, :]
                moved += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            back = after @ step.T
            b[:k] = back / back.sum(1, keepdims=True)
    return (p, moved) if pairs else p


def _observed_moves(tags: np.ndarray, counts: np.ndarray) -> np.ndarray:
    begin, _ = windows(counts)
    inner = np.ones(len(tags), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    return np.bincount(2 * tags[at - 1] + tags[at], minlength=4).reshape(2, 2).astype(float)


class Field:
    """Weights of features, bias and transitions, and the logistic function of document scores."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bias = -6.0
        self.move = np.array([[0.0, -0.5], [-0.5, 0.0]])
        self.logistic = np.zeros(3)

    def emissions(self, distinct: list[str]) -> np.ndarray:
        get = self.weights.get
        return np.array([self.bias + sum(get(f, 0.0) for f in word_features(w)) for w in distinct])

    def fit_tags(self, of: np.ndarray, distinct: list[str], counts: np.ndarray, tags: np.ndarray, turns: int = 15) -> None:
        """Adaptive gradient ascent of the tags' likelihood with a small L2 penalty."""
        doc = np.repeat(np.arange(len(counts)), counts)
        held = np.bincount(np.unique(doc * len(distinct) + of) % max(1, len(distinct)), minlength=len(distinct))
        spread = Counter()  # documents that hold a feature: what one document alone has tells nothing
        for w, n in zip(distinct, held.tolist(), strict=True):
            for f in word_features(w):
                spread[f] += n
        names: dict[str, int] = {}
        rows, cols = [], []
        for i, w in enumerate(distinct):
            for f in word_features(w):
                if spread[f] < 2:
                    continue
                rows.append(i)
                cols.append(names.setdefault(f, len(names)))
        rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
        weights = np.array([self.weights.get(f, 0.0) for f in names])
        observed = np.bincount(of, weights=tags, minlength=len(distinct))
        moves = _observed_moves(tags, counts)
        g2, m2, b2 = np.full(len(names), 1e-2), np.full((2, 2), 1e-2), 1e-2
        for _ in range(turns):
            score = self.bias + np.bincount(rows, weights=weights[cols], minlength=len(distinct))
            p, moved = marginals(score[of], counts, self.move, pairs=True)
            miss = observed - np.bincount(of, weights=p, minlength=len(distinct))
            grad = np.bincount(cols, weights=miss[rows], minlength=len(names)) - 0.02 * weights
            g2 += grad**2
            weights += 0.8 * grad / np.sqrt(g2)
            turn = moves - moved - 0.02 * self.move
            m2 += turn**2
            self.move = self.move + 0.2 * turn / np.sqrt(m2)
            self.move -= self.move[0, 0]
            b = float(miss.sum())
            b2 += b * b
            self.bias += 0.5 * b / b2**0.5
        self.weights = {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 0.01}

    def document_features(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """1, log-odds that some word is toxic, log of 1 + the expected number of toxic words."""
        clear = np.where(p >= 0.02, p, 0.0)  # the background of long texts is no evidence
        edges = np.concatenate([[0], np.cumsum(counts)])
        none = np.diff(np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(clear, 1 - 1e-9)))])[edges])
        some = np.clip(-np.expm1(none), 1e-4, 1 - 1e-4)
        expected = np.diff(np.concatenate([[0.0], np.cumsum(clear)])[edges])
        return np.stack([np.ones(len(counts)), np.log(some / (1 - some)), np.log1p(np.maximum(expected, 0))], 1)

    def fit_logistic(self, x: np.ndarray, y: np.ndarray) -> None:
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
        self.logistic = w

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, probability of each word, words of each text."""
        of, distinct, counts = split_words(texts)
        p = marginals(self.emissions(distinct)[of], counts, self.move)
        z = self.document_features(p, counts) @ self.logistic
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), p, counts


def train(texts: list[str], toxic: np.ndarray) -> Field | None:
    """A field fitted to labelled texts, None where they have one label only."""
    if not toxic.any() or toxic.all():
        return None
    of, distinct, counts = split_words(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}
    pairs = np.unique(doc * len(distinct) + of)
    features = [word_features(w) for w in distinct]
    for d, group in zip(range(len(counts)), np.split(pairs % max(1, len(distinct)), np.searchsorted(pairs // max(1, len(distinct)), np.arange(1, len(counts)))), strict=True):
        held[int(toxic[d])].update({f for w in group.tolist() for f in features[w]})
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    after = np.concatenate([[-1], of[:-1]])
    after[np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]] = -1  # the first word of a text
    contexts = np.unique((after * len(distinct) + of)[toxic[doc]]) % len(distinct) if len(of) else of
    support = Counter()
    for w, n in zip(*np.unique(contexts, return_counts=True), strict=True):
        for f in features[w]:
            support[f] += int(n)

    def telling(f: str) -> bool:
        k = held[1][f]
        return support[f] >= SUPPORT and np.log((k + 0.5) / (n1 + 1)) - np.log((held[0][f] + 0.5) / (n0 + 1)) >= ODDS

    lexicon = np.array([any(map(telling, fs)) for fs in features], bool)
    field = Field()
    tags = (lexicon[of] & toxic[doc]).astype(np.int64)
    field.fit_tags(of, distinct, counts, tags)
    p = marginals(field.emissions(distinct)[of], counts, field.move)
    field.fit_tags(of, distinct, counts, ((p >= 0.5) & toxic[doc]).astype(np.int64))
    p = marginals(field.emissions(distinct)[of], counts, field.move)
    field.fit_logistic(field.document_features(p, counts), toxic.astype(float))
    return field


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Field | None:
    """Fit on the labelled documents with the smallest hashes that are not held out."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = known.where("toxic IS NOT NULL").orderBy(order, "doc_id").limit(fit_docs)
    # at most fit_docs rows of two numbers
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True)]
        field = train([t or "" for t, _ in rows], np.array([y == 1 for _, y in rows], bool)) if rows else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(field and vars(field))], pa.binary())], ["model"])

    ordered = texts.repartition(1).sortWithinPartitions("doc_id")
    rows = ordered.mapInArrow(learn, "model binary").collect()  # one row, bounded by the sample
    state = pickle.loads(rows[0]["model"]) if rows else None
    if not state:
        return None
    field = Field()
    vars(field).update(state)
    return field


def score(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start and end of toxic words, in code points) of every document."""
    field = fit(docs, labels, fit_docs)
    rows = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    none = F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    harmless = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), none)
    if field is None:
        return harmless
    sent = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                scores, p, counts = sent.value.scores(texts)
                edges = np.concatenate([[0], np.cumsum(counts)])
                spans: list[list] = [[] for _ in texts]
                for d in np.unique(np.searchsorted(edges, np.flatnonzero(p >= 0.5), side="right") - 1).tolist():
                    words = [m.span() for m in re.finditer(r"\S+", texts[d])]
                    at = np.flatnonzero(p[edges[d] : edges[d + 1]] >= 0.5).tolist()
                    spans[d] = [{"start": words[i][0], "end": words[i][1]} for i in at if i < len(words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, span)],
                    ["doc_id", "held_out", "score", "predicted", "spans"],
                )

    return rows.mapInArrow(apply, harmless.schema)
