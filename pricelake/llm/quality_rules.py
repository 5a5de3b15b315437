"""Quality rules: word and line measures, and cross-document line frequency.

A line is normalised (A-Z lower-cased, runs of white space as one space, trimmed) and hashed. For
each host (``source``) the distinct documents that hold a line are counted; exact copies of a text
count once. A line above the limit (more than ``min_docs`` documents and more than ``max_share`` of
the host's distinct documents) is boilerplate: it stays only in its first document (smallest
``doc_id``) and is removed from the others. A document that loses more than ``max_removed`` of its
words is depleted and rejected.

Everything is DataFrame functions. Counting combines before each shuffle, and a very common line is
joined to its documents under the adaptive skew join.

Defined cases: a null text counts as empty and fails the base rule; a null source is a host of its
own; repeated rows are judged alike; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import SPACE_CLASS, ascii_lower, carried, distilled, stripped, whole_text, words_of, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is boilerplate on a host above both limits.
MIN_DOCS = 20
MAX_SHARE = 0.01
#: Share of its words that a document may lose.
MAX_REMOVED = 0.7


def measures(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows of three words are compared by a 64-bit hash within their text. Only a text with equal
    hashes goes on: its windows are sorted as numbers made of a hash's upper bits and the place,
    neighbours with equal upper bits are compared by the full hash, and the words under windows
    found twice or more are counted once.
    """
    text = whole_text()
    lines = F.filter(F.split(text, "\n"), lambda x: stripped(x) != "")
    base = docs.withColumns({
        "_words": words_of(text),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "_lines": lines,
    })
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    base = base.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.when(F.size("_words") > 2, windows),
    }).drop("_words", "_lines")
    # null where no window repeats; places take as many of the lowest bits as they need
    base = base.withColumn("_hashes", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.col("_hashes")))
    bits = F.length(F.bin(F.size("_hashes"))).cast("int")
    base = base.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    base = base.withColumn(
        "_packed", F.sort_array(F.transform("_hashes", lambda h, i: h.bitwiseAND(F.bitwise_not("_mask")).bitwiseOR(i)))
    )

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not("_mask")) == 0, F.lit(False))

    near = F.filter("_packed", lambda x, k: alike(x, F.get("_packed", k - 1)) | alike(x, F.get("_packed", k + 1)))
    place = F.transform(near, lambda x: x.bitwiseAND(F.col("_mask")).cast("int"))
    base = base.withColumn("_places", place).drop("_packed", "_mask")
    full = F.sort_array(F.transform("_places", lambda i: F.struct(F.get("_hashes", i).alias("h"), i.alias("i"))))
    base = base.withColumn("_sorted", full).drop("_places", "_hashes")

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get("_sorted", k - 1)["h"], F.get("_sorted", k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_sorted")


def normal_line(lowered: Column) -> Column:
    """A lower-cased line as it is compared between documents: runs of white space are one space."""
    return F.regexp_replace(stripped(lowered), f"{SPACE_CLASS}{{2,}}|[\\x09-\\x0D]", " ")


def document_lines(docs: DataFrame) -> DataFrame:
    """One row for each line with a word: its place, the hash of its normal form, its words."""
    text = whole_text()
    split = docs.select(
        "doc_id", "source", F.xxhash64(text).alias("fp"), F.posexplode(F.split(ascii_lower(text), "\n")).alias("at", "line")
    )
    line = split.withColumn("line", normal_line(F.col("line"))).where("line <> ''")
    words = F.char_length("line") - F.char_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return line.select("doc_id", "source", "fp", "at", F.unhex(F.md5("line")).alias("line"), words.cast("long").alias("words"))


def common_lines(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Lines above the limits: source, line, n_docs (distinct texts), first_doc. lines: document_lines of docs."""
    texts = docs.select("source", F.xxhash64(whole_text()).alias("fp")).distinct()
    hosts = texts.groupBy(F.col("source").alias("_host")).agg(F.count(F.lit(1)).alias("host_docs"))
    # one row for each line and text, then one for each line
    counted = (
        lines.groupBy("source", "line", "fp").agg(F.min("doc_id").alias("first_doc"))
        .groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first_doc").alias("first_doc"))
        .where(F.col("n_docs") > min_docs)
    )
    return counted.join(hosts, F.col("source").eqNullSafe(F.col("_host"))).where(
        F.col("n_docs") > F.col("host_docs") * F.lit(max_share)
    ).select("source", "line", "n_docs", "first_doc")


def removed_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """One row for each line that a document loses: doc_id, source, fp, at, line, words."""
    lines = written(document_lines(docs), "lines")
    common = common_lines(docs, lines, min_docs, max_share).select(
        F.col("source").alias("_host"), F.col("line").alias("_line"), "first_doc"
    )
    return (
        lines.join(common, (F.col("line") == F.col("_line")) & F.col("source").eqNullSafe(F.col("_host")))
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .select("doc_id", "source", "fp", "at", "line", "words")
        .dropDuplicates(["doc_id", "source", "fp", "at"])  # rows that repeat a document
    )


def judge(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """All columns of the documents with the measures, removed_words, base_failed and kept.

    To filter by a verdict write the result first, as ``keep_good`` does: a filter that Spark pushes below
    the measures repeats their expressions.
    """
    lost = removed_lines(docs, min_docs, max_share).groupBy("doc_id", "source", "fp").agg(F.sum("words").alias("removed_words"))
    lost = lost.withColumnsRenamed({"doc_id": "_id", "source": "_host", "fp": "_fp"})
    same = (F.col("fp") == F.col("_fp")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_host"))
    measured = measures(docs.withColumn("fp", F.xxhash64(whole_text())))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = measured.join(lost, same, "left").drop("fp", "_id", "_host", "_fp")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    depleted = F.col("removed_words") > F.col("n_words") * F.lit(max_removed)
    return out.withColumns({"base_failed": failed, "depleted": depleted, "kept": ~failed & ~depleted})


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that are kept, with their own columns and whole texts.

    The verdicts are written first: pushed below the measures, the filter would repeat them. They are
    keys without texts, so the disk holds no second copy of the documents.
    """
    key = F.xxhash64(whole_text())
    rows = docs.select("doc_id", "source", "text", key.alias("_key"))
    verdicts = distilled(docs.sparkSession, lambda: judge(rows, **settings).select("doc_id", "source", "_key", "kept"), "verdicts")
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("source").alias("_host"), F.col("_key").alias("_gone"))
    keyed = carried(docs, "doc_id", "source", "text").withColumn("_key", key)
    same = (F.col("_key") == F.col("_gone")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_host"))
    return keyed.join(gone, same, "left_anti").select("_row.*")


def clean_texts(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """doc_id, source, text of every document that has a line, without the removed lines."""
    text = whole_text()
    split = docs.select("doc_id", "source", F.xxhash64(text).alias("fp"), F.posexplode(F.split(text, "\n")).alias("at", "text"))
    lost = removed_lines(docs, min_docs, max_share).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_host"), F.col("fp").alias("_fp"), F.col("at").alias("_at")
    )
    left = split.join(
        lost,
        (F.col("at") == F.col("_at")) & (F.col("fp") == F.col("_fp"))
        & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_host")),
        "left_anti",
    )
    rows = F.array_sort(F.collect_set(F.struct("at", "text")))  # the lines of one document
    return left.groupBy("doc_id", "source", "fp").agg(rows.alias("rows")).select(
        "doc_id", "source", F.array_join(F.transform("rows", lambda r: r["text"]), "\n").alias("text")
    )
