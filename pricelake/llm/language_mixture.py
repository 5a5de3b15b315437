"""Languages of texts by multilingual mixture inference.

Each language is a distribution over hashed character trigrams of words, counted over all learning documents. A text is
a mixture: every word comes from one language, with the text's proportions as prior. Expectation-maximisation
estimates the proportions from the words' likelihoods; a word may also be noise (a name, a typo), which any language
explains at the price of ``NOISE``. Then the text's set of languages is chosen among the nested sets of its largest proportions:
the one whose log-likelihood, less a penalty for each further language that grows with the log of the number of
words, is best. The language predicted has the largest proportion in that set; the score is its proportion
in the mixture of all languages, drawn towards equal ones by one word for each language.

One pass counts trigrams (tasks add up their own, so a language with a third of all rows is spread over all tasks), one pass infers;
the model is ``BUCKETS`` numbers for each language, whatever the number of documents.

Defined cases: a null text, or one without letters, is ``und`` with score 0 and no languages, and so is everything if nothing
was learned; repeated rows count each; a null ``doc_id`` is not held out; further columns are ignored; an empty table
gives no rows. More than ``MAX_LANGUAGES`` learned languages are an error: then the column does not hold languages.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.arrow_text import byte_slices

BUCKETS = 1 << 16
#: Bounds the model to 64 MB.
MAX_LANGUAGES = 256
NOISE = 1e-3
#: Added to each count of a trigram.
SMOOTHING = 0.5
PENALTY = 1.0
ITERATIONS = 24
UNKNOWN = "und"
_STEP = 4
_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
_NAMES = ["doc_id", "held_out", "lang_pred", "score", "languages"]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each word its text and its number among the distinct words; the distinct words. Words are runs of letters and marks, lower-cased."""
    plain = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    spaced = pc.utf8_trim(pc.replace_substring_regex(plain, r"[^\pL\pM]+", " "), " ")
    parts = pc.split_pattern(spaced, " ")
    words = parts.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(words.filter(full))
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())[full.to_numpy(zero_copy_only=False)]
    return text, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def trigram_buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all words, each with a space at both ends, and how many each word has."""
    joined = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    sizes = pc.utf8_length(joined).to_numpy().astype(np.int64)
    points = np.frombuffer("".join(joined.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    first = np.ones(len(points), bool)
    ends = np.cumsum(sizes)
    first[ends - 1] = first[ends - 2] = False  # the last two places of a word start no trigram
    at = np.flatnonzero(first)
    mixed = (points[at] * np.uint64(0x9E3779B97F4A7C15) + points[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + points[at + 2] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64), sizes - 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams by language over all rows of the task."""
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
    for batch in batches:
        for part in byte_slices(batch):
            text, word, distinct = split_words(part.column("text"))
            if not len(word):
                continue
            bucket, size = trigram_buckets(distinct)
            coded = pc.dictionary_encode(part.column("lang"))
            lang = coded.indices.to_numpy()[text]
            for i, name in enumerate(coded.dictionary.to_pylist()):
                times = np.bincount(word[lang == i], minlength=len(distinct))
                counts[name] += np.bincount(bucket, np.repeat(times, size), BUCKETS).astype(np.int64)
    for name, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], ["lang", "bucket", "n"])


class Model:
    """Log-probabilities of trigrams in each learned language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0) + SMOOTHING * BUCKETS
        self.logs = (np.log(counts + SMOOTHING) - np.log(total)).astype(np.float32)

    def likelihoods(self, words: pa.Array) -> np.ndarray:
        """Of each word and language, relative to the word's best language, with noise."""
        bucket, size = trigram_buckets(words)
        logs = np.add.reduceat(self.logs[bucket].astype(np.float64), np.cumsum(size) - size, axis=0)
        return NOISE + (1 - NOISE) * np.exp(logs - logs.max(axis=1, keepdims=True))

    def infer(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Proportions in the mixture of all languages, in the chosen set (0 outside), and the number of words."""
        n_texts, n_langs = len(texts), len(self.languages)
        full, chosen = np.zeros((n_texts, n_langs)), np.zeros((n_texts, n_langs))
        text, word, distinct = split_words(texts)
        n_words = np.bincount(text, minlength=n_texts)
        if not len(word):
            return full, chosen, n_words
        # a text's distinct words with their counts
        pair, times = np.unique(text * len(distinct) + word, return_counts=True)
        text, word = pair // len(distinct), pair % len(distinct)
        spoken = np.unique(text)
        words = Words(self.likelihoods(distinct)[word], times, np.searchsorted(spoken, text))
        mixture, best_possible = words.fit(np.ones((len(spoken), n_langs)))
        order = np.argsort(-mixture, axis=1, kind="stable")
        cost = PENALTY * np.log1p(n_words[spoken])
        best, best_value = np.zeros_like(mixture), np.full(len(spoken), -np.inf)
        active = np.arange(len(spoken))
        for m in range(1, n_langs + 1):
            allowed = np.zeros((len(active), n_langs))
            np.put_along_axis(allowed, order[active, :m], 1.0, axis=1)
            shares, value = words.of(active).fit(allowed * np.maximum(mixture[active], 1e-6))
            better = value - cost[active] * (m - 1) > best_value[active]
            at = active[better]
            best[at], best_value[at] = shares[better], (value - cost[active] * (m - 1))[better]
            # no larger set can be more likely than all languages together
            active = active[best_possible[active] - cost[active] * m > best_value[active]]
            if not len(active):
                break
        full[spoken], chosen[spoken] = mixture, best
        return full, chosen, n_words


class Words:
    """Distinct words of some texts: likelihoods, counts and the text (0, 1, ... in order, none without words)."""

    def __init__(self, likelihoods: np.ndarray, times: np.ndarray, text: np.ndarray):
        self.likelihoods, self.times, self.text = likelihoods, times, text
        self.starts = np.flatnonzero(np.diff(text, prepend=-1))

    def of(self, texts: np.ndarray) -> Words:
        """The words of some of the texts, given in order."""
        if len(texts) == len(self.starts):
            return self
        at = np.isin(self.text, texts)
        return Words(self.likelihoods[at], self.times[at], np.searchsorted(texts, self.text[at]))

    def fit(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by expectation-maximisation from a start, whose zeros stay, and the log-likelihoods."""
        shares = start / start.sum(axis=1, keepdims=True)
        active = np.arange(len(shares)) if (np.count_nonzero(start, axis=1) > 1).any() else np.zeros(0, np.int64)
        for _ in range(0, ITERATIONS, _STEP):
            if not len(active):
                break
            words, now = self.of(active), shares[active]
            total = np.add.reduceat(words.times, words.starts)[:, None]
            for _ in range(_STEP):
                drawn = now[words.text] * words.likelihoods
                drawn *= (words.times / drawn.sum(axis=1))[:, None]
                before, now = now, np.add.reduceat(drawn, words.starts, axis=0) / total
            shares[active] = now
            active = active[np.abs(now - before).max(axis=1) > 1e-3]
        each = np.log((shares[self.text] * self.likelihoods).sum(axis=1)) * self.times
        return shares, np.add.reduceat(each, self.starts)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Count the trigrams of all rows with a language."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most BUCKETS rows for each language
    found = counts.toArrow().sort_by([("lang", "ascending"), ("bucket", "ascending")])
    if not found.num_rows:
        return None
    coded = found.column("lang").combine_chunks().dictionary_encode()
    languages = coded.dictionary.to_pylist()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MAX_LANGUAGES} can be learned")
    table = np.zeros((BUCKETS, len(languages)))
    table[found.column("bucket").to_numpy(), coded.indices.to_numpy()] = found.column("n").to_numpy()
    return Model(languages, table)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (chosen set with shares, largest first) of every document.

    Learns from the rows with a language that are not held out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = learn(rows.where(~held_out(F.col("doc_id"))))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        none = F.array().cast("array<struct<lang:string,share:double>>").alias("languages")
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in byte_slices(batch):
                full, chosen, n = model.infer(part.column("text"))
                spoken = chosen.sum(axis=1) > 0
                pred = np.where(spoken, chosen.argmax(axis=1), len(model.languages))
                share = full[np.arange(len(full)), np.minimum(pred, full.shape[1] - 1)]
                score = np.where(spoken, (n * share + 1) / (n + full.shape[1]), 0.0)
                sets = [
                    [{"lang": names[k], "share": float(row[k])} for k in np.argsort(-row, kind="stable") if row[k] > 0]
                    for row in chosen
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names[pred], pa.string()), pa.array(score, pa.float64()), pa.array(sets, kind)],
                    _NAMES,
                )

    return rows.mapInArrow(apply, _SCHEMA)
