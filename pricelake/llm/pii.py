"""Personal data: base patterns, and spans that boosted trees add to them.

Base spans are matches of fixed patterns that pass their checks; they always stay. High-recall
generators then propose further, overlapping candidates (long digit groups, key-like strings,
spelled-out addresses). Gradient-boosted trees score each candidate by format and context features.
They learn from labelling rules: a candidate that is a base span, or that follows a name such as
``password=``, is positive, the others are negative. A threshold for each generator is calibrated on
rows that the trees have not seen; candidates above it that touch no base span are added, the best
one of each run of overlapping candidates.

The trees and the thresholds come from all candidates: a feature is read as the number of its ``CUTS``
that it reaches, candidates alike in all of them are counted, and the trees are fitted on these counts
as weights. They read each cut as a yes or no, so Spark ML looks for no split points of its own in a
sample. Only DataFrame functions and Spark ML are used. Matches get their places from the lengths of
what lies between them; patterns are written without backtracking, so that long runs of digits or
letters cost linear time.

Defined cases: a null text counts as empty and has no spans; repeated rows are judged alike; a corpus
without positive or without negative candidates gets base spans only; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import whole_text, written

#: Share of positives that candidates above a threshold must have on unseen rows.
PRECISION = 0.98

KINDS = ("email", "ip", "card", "phone")
# Base patterns. (?:\G|(?<!x)) starts a run of x only at its first character, or where a match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Generators of candidates: name -> (what a text must contain, pattern).
GENERATORS = {
    "number": (r"[0-9]", r"(?:\G|(?<![0-9(+]))[+(]?[0-9](?:[\x20().-]{0,2}+[0-9]){5,}+"),
    "secret": (r"[0-9]", r"(?:\G|(?<![A-Za-z0-9_+/-]))(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+"),
    "email": (r"(?i)\bat\b.*\bdot\b|@", r"(?i)[a-z0-9._+-]{1,64}+(?:\x20?@\x20?|\x20[(\[]?at[)\]]?\x20)[a-z0-9-]{1,64}+(?:\x20?\.\x20?|\x20[(\[]?dot[)\]]?\x20)[a-z]{2,24}"),
}
SECRET_NAME = r"(?i)(?:passw(?:or)?d|passwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?$"
KEY_FORM = r"^AKIA[0-9A-Z]{16}$"
FEATURES = (
    "length", "digits", "lower", "upper", "others", "digit_share", "distinct", "digit_runs", "hex", "dots",
    "dashes", "after_equals", "after_quote", "after_plus", "after_colon", "named_secret", "named_contact", "named_payment", "before_quote",
)
_FEW = (1, 2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 64)
_CUTS = {
    "length": (*range(7, 22), 24, 28, 32, 36, 40, 48, 64, 128),
    "digits": (*range(1, 21), 24, 32, 40, 64),
    "digit_share": tuple(i / 10 for i in range(1, 11)),
    **dict.fromkeys(("lower", "upper", "others", "distinct", "digit_runs", "dots", "dashes"), _FEW),
}
#: What the trees may ask of each feature: whether it reaches a cut. The others are 0 or 1.
CUTS = {f: _CUTS.get(f, (1,)) for f in FEATURES}


def matches(text: Column, needs: Column, pattern: str) -> Column:
    """Matches in order as struct<gap, text>: what lies before the match since the last one, and the match."""
    found = F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(needs, F.split(text, pattern))
    return F.slice(F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("text"))), F.lit(1), F.size(found))


def placed(found: Column, keep: Column | None = None) -> Column:
    """start, end, text and before (the characters just before) of each match.

    Two folds, over chunks and within a chunk: adding to an array copies it, so one fold over a
    text of very many matches would take quadratic time.
    """
    span = "array<struct<start:int,end:int,text:string,before:string>>"
    chunk = 256
    empty = F.array().cast(span)

    def inside(at: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(at.alias("at"), empty.alias("spans")),
            lambda a, m: F.struct(
                (a["at"] + F.char_length(m["gap"]) + F.char_length(m["text"])).alias("at"),
                F.concat(
                    a["spans"],
                    F.array(
                        F.struct(
                            (a["at"] + F.char_length(m["gap"])).alias("start"),
                            (a["at"] + F.char_length(m["gap"]) + F.char_length(m["text"])).alias("end"),
                            m["text"].alias("text"),
                            F.right(m["gap"], F.lit(24)).alias("before"),
                        )
                    ),
                ).alias("spans"),
            ),
        )

    def step(a: Column, i: Column) -> Column:
        done = inside(a["at"], F.slice(found, i * chunk + 1, F.lit(chunk)))
        return F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(a["all"], F.array(d["spans"])).alias("all")))[0]

    chunks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / chunk).cast("int"))
    whole = F.aggregate(
        chunks,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("all")),
        step,
        lambda a: F.flatten(a["all"]),
    )
    return F.when(F.size(found) > 0, whole).otherwise(empty)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of card numbers."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, text: Column) -> Column:
    n = F.char_length(digits_of(text))
    if kind == "ip":
        return text.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits_of(text))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, fp (hash of the text), base spans by kind, candidates; one row for each document."""
    text = whole_text()
    needs = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    found = docs.select(
        "doc_id",
        F.xxhash64(text).alias("fp"),
        *(matches(text, needs[k], patterns[k]).alias(f"m_{k}") for k in KINDS),
        *(matches(text, text.rlike(need), pattern).alias(f"c_{g}") for g, (need, pattern) in GENERATORS.items()),
    )
    spans = found.select("doc_id", "fp", *(placed(F.col(c)).alias(c) for c in found.columns[2:]))

    def base(k: str) -> Column:
        kept = F.filter(f"m_{k}", lambda s: _valid(k, s["text"]))
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k)

    def proposed(g: str) -> Column:
        return F.transform(f"c_{g}", lambda s: F.struct(F.lit(g).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "text", "before"))))

    candidates = F.concat(*(proposed(g) for g in GENERATORS))
    return spans.select("doc_id", "fp", *(base(k) for k in KINDS), candidates.alias("candidates"))


def features(rows: DataFrame) -> DataFrame:
    """Add the features of candidate rows (kind, text, before), all as doubles."""
    t, before = F.col("text"), F.col("before")

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern))

    made = {
        "length": F.char_length(t),
        "digits": count("[0-9]"),
        "lower": count("[a-z]"),
        "upper": count("[A-Z]"),
        "others": count("[^A-Za-z0-9]"),
        "digit_share": count("[0-9]") / F.char_length(t),
        "distinct": F.size(F.array_distinct(F.split(t, ""))),
        "digit_runs": count("[0-9]+"),
        "hex": t.rlike("^[0-9a-f]+$"),
        "dots": count("[.]"),
        "dashes": count("-"),
        "after_equals": before.rlike("=[\\x20\"']*$"),
        "after_quote": before.rlike("[\"']$"),
        "after_plus": before.rlike("[+(]$"),
        "after_colon": before.rlike(":[\\x20\"']*$"),
        "named_secret": before.rlike("(?i)(?:passw|secret|token|key|auth)"),
        "named_contact": before.rlike("(?i)(?:tel|phone|call|fax|mobile|mail|contact)"),
        "named_payment": before.rlike("(?i)(?:card|visa|iban|account|pay)"),
        "before_quote": before.rlike("[A-Za-z]\\x20$"),
    }
    return rows.withColumns({k: made[k].cast("double") for k in FEATURES})


def labelled(rows: DataFrame) -> DataFrame:
    """Add the label of the labelling rules: 1 where a candidate is surely private, else 0."""
    t = F.col("text")
    number = F.concat(F.when(F.substring("before", -1, 1) == "+", "+").otherwise(""), t)
    sure = (
        ((F.col("kind") == "email") & t.rlike("^" + EMAIL.partition("))")[2] + "$"))
        | ((F.col("kind") == "number") & (_valid("ip", t) | (_valid("card", t) & t.rlike(f"^{CARD}$")) | (number.rlike(f"^{PHONE}$") & _valid("phone", t))))
        | ((F.col("kind") == "secret") & (F.col("before").rlike(SECRET_NAME) | t.rlike(KEY_FORM)))
    )
    return rows.withColumn("label", sure.cast("double"))


def levels(rows: DataFrame) -> DataFrame:
    """Candidate rows with each feature as the number of its cuts that it reaches."""

    def level(f: str) -> Column:
        cuts = F.array(*(F.lit(float(c)) for c in CUTS[f]))
        # one array element: inside a lambda alone the feature would be computed again for each cut
        return F.transform(F.array(f), lambda x: F.size(F.filter(cuts, lambda c: c <= x)))[0]

    return features(rows).withColumns({f: level(f) for f in FEATURES})


def counted(candidates: DataFrame) -> DataFrame:
    """kind, the levels, label, unseen (a quarter, by hash) and n: how many of all candidates are so."""
    order = F.xxhash64("text", "before", "kind", "doc_id", "start")
    rows = levels(labelled(candidates.select("kind", "text", "before", (order % 4 == 0).alias("unseen"))))
    alike = ["kind", *FEATURES, "label", "unseen"]
    return rows.groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("n")).sortWithinPartitions(*alike)


def fit(candidates: DataFrame, precision: float = PRECISION):
    """Trees and a threshold for each generator, or None where the rows have one label only.

    All candidates count, three quarters for the trees and a quarter for the thresholds.
    """
    ready = written(counted(candidates), "pii-fit")
    seen = ready.where("NOT unseen")
    if seen.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxIter=8, maxDepth=4, stepSize=0.4, seed=1, featuresCol="features", labelCol="label", weightCol="n")
    model = trees.fit(seen.select(_vector(), "label", "n"))
    scored = score(ready, (model, None))
    # the lowest of 50 cuts above which the unseen rows are as pure as asked
    cut = F.explode(F.sequence(F.lit(0), F.floor(F.col("p") * 50).cast("int"))).alias("cut")
    pure = (
        scored.where("unseen").select("kind", "label", "n", cut).groupBy("kind", "cut")
        .agg((F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("share")).where(F.col("share") >= precision)
        .groupBy("kind").agg(F.min("cut").alias("cut")).collect()
    )
    return model, {r["kind"]: max(0.5, r["cut"] / 50) for r in pure}


def _vector() -> Column:
    """All cuts as 0 or 1, from the levels; marked as categories, whose splits need no search."""

    def reached(f: str) -> Column:
        n = len(CUTS[f])
        return F.slice(F.array(*map(F.lit, [1.0] * n + [0.0] * n)), F.lit(n + 1) - F.col(f), F.lit(n))

    n = sum(map(len, CUTS.values()))
    attributes = {"ml_attr": {"attrs": {"binary": [{"idx": i} for i in range(n)]}, "num_attrs": n}}
    return array_to_vector(F.concat(*map(reached, FEATURES))).alias("features", metadata=attributes)


def score(rows: DataFrame, fitted) -> DataFrame:
    """Add p, the probability of candidate rows that have their levels."""
    kept = [c for c in rows.columns if c not in FEATURES]
    out = fitted[0].transform(rows.select(*kept, _vector()))
    return out.select(*kept, F.round(vector_to_array("probability")[1], 9).alias("p"))


def find(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, the base spans of each kind (start, end) and all spans: array of kind, start, end."""
    found = written(extract(docs), "pii")
    rows = found.select("doc_id", "fp", F.explode("candidates").alias("c")).select("doc_id", "fp", "c.*")
    fitted = fit(rows, precision)
    def rank_of(kind: Column) -> Column:
        return F.coalesce(*(F.when(kind == k, i) for i, k in enumerate(KINDS)), F.lit(len(KINDS)))

    def as_spans(k: str) -> Column:
        return F.transform(k, lambda s: F.struct(F.lit(KINDS.index(k)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind")))

    base = found.withColumn("base", F.concat(*(as_spans(k) for k in KINDS))).drop("candidates")
    if fitted is None or not fitted[1]:
        return base.withColumn("spans", F.col("base")).drop("fp")
    limit = F.lit(2.0)
    for kind, least in fitted[1].items():
        limit = F.when(F.col("kind") == kind, F.lit(least)).otherwise(limit)
    chosen = score(levels(rows), fitted).where(F.col("p") >= limit).select("doc_id", "fp", "kind", "start", "end", "p")
    known = base.select("doc_id", "fp", F.explode("base").alias("b")).select(
        "doc_id", "fp", "b.kind", "b.start", "b.end", F.lit(2.0).alias("p")
    )
    every = chosen.unionByName(known).dropDuplicates(["doc_id", "fp", "kind", "start", "end", "p"])
    text = W.partitionBy("doc_id", "fp").orderBy("start", "end", "kind", "p")
    reach = F.max("end").over(text.rowsBetween(W.unboundedPreceding, -1))
    runs = every.withColumn("new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(text.rowsBetween(W.unboundedPreceding, 0)))
    best = F.max(F.struct("p", (F.col("end") - F.col("start")).alias("n"), "start", "end", "kind")).alias("best")
    added = runs.groupBy("doc_id", "fp", "run").agg(best).where("best.p <= 1").select(
        F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"),
        F.struct(
            rank_of(F.col("best.kind")).alias("rank"),
            F.col("best.start").alias("start"), F.col("best.end").alias("end"), F.col("best.kind").alias("kind"),
        ).alias("span"),
    )
    added = added.groupBy("_id", "_fp").agg(F.collect_list("span").alias("added"))  # spans of one text
    same = (F.col("fp") == F.col("_fp")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    out = base.join(added, same, "left")
    more = F.coalesce("added", F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>"))
    return out.withColumn("spans", F.sort_array(F.concat("base", more))).drop("fp", "_fp", "_id", "added")


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (of ``find``) replaced by its kind in angle brackets."""
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(
        by_start,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
            ),
        ).otherwise(a),
    )
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))
