"""The registered queries of the training-data operators and, where there is one, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import (
    collocations,
    exact_dedup,
    hard_negatives,
    html_text,
    language_mixture,
    near_dedup,
    packing,
    pii,
    quality_rules,
    source_mix,
    token_files,
    toxicity,
    url_rules,
)
from pricelake.llm.common import shared_folder
from pricelake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_url_rules",
    r"""
    WITH u AS (
      SELECT page_id,
             translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages
    ), ruled AS (
      SELECT *, CASE
          WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
          WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
          WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
          WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
          WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
        END AS rule
      FROM u
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN regexp_matches(host, '(^|[^A-Za-z0-9])(cheap-pills|casino-win|free-bets|spam-farm|ads-track)($|[^A-Za-z0-9])') THEN 'block'
        ELSE 'allow' END AS verdict
    FROM ruled
    """,
)
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write_files(table(spark, sf_dir, "documents"), folder)
    return token_files.read_files(spark, folder, with_ids=False)


@query(
    "op5_quality_rules",
    rf"""
    WITH d AS (
      SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS fp,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), lines AS (
      SELECT doc_id, source, fp,
             trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
      FROM (SELECT doc_id, source, fp, unnest(string_split(text, chr(10))) AS line FROM d)
    ), hosts AS (
      SELECT source, count(DISTINCT fp) AS host_docs FROM d GROUP BY source
    ), common AS (
      SELECT l.source, line, min(doc_id) AS first_doc
      FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
      WHERE line <> ''
      GROUP BY l.source, line, host_docs
      HAVING count(DISTINCT fp) > {quality_rules.MIN_DOCS} AND count(DISTINCT fp) > host_docs * {quality_rules.MAX_SHARE}
    ), lost AS (
      SELECT l.doc_id, sum(len(string_split(l.line, ' '))) AS removed
      FROM lines l JOIN common c ON l.line = c.line AND l.source IS NOT DISTINCT FROM c.source
      WHERE l.doc_id <> c.first_doc
      GROUP BY l.doc_id
    ), windows AS (
      SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2
    ), grams AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows
    ), repeats AS (
      SELECT doc_id, count(DISTINCT p) AS n
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1)
      GROUP BY doc_id
    ), measured AS (
      SELECT d.doc_id, len(w)::BIGINT AS n_words,
             coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT
               AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             coalesce(l.removed, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN repeats r USING (doc_id) LEFT JOIN lost l USING (doc_id)
    )
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
             AND NOT removed_words > n_words * {quality_rules.MAX_REMOVED} AS kept
    FROM measured
    """,
)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"
    )


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op7_source_mix")
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents")).documents
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op8_minhash_forest",
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), shared AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
      FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id
    ), links AS (
      SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * common >= 85 * (x.n + y.n - common)
    ), reach(a, b) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    )
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
    FROM d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = d.doc_id
    GROUP BY d.doc_id, n
    """,
)
def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(
    "op10_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents
    ), g AS (
      SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM d JOIN g USING (norm)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
    ), p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


@query("op12_language_mixture")
def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_mixture.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query(
    "op13_collocations",
    r"""
    WITH d AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ), w AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d
    ), g AS (
      SELECT lang, w[i:i + k - 1] AS p
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))
    ), f AS (
      SELECT lang, array_to_string(p, ' ') AS phrase, len(p) AS words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
    ), totals AS (
      SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
    ), cuts AS (
      SELECT lang, phrase, words, f AS a, unnest(range(1, words)) AS k, string_split(phrase, ' ') AS p FROM f WHERE words > 1
    ), scored AS (
      SELECT c.lang, c.phrase, c.words, c.a, l.f AS l, r.f AS r, n, k,
             ((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(p[1:k], ' ')
                  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(p[k + 1:], ' ')
                  JOIN totals t ON t.lang = c.lang
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
    ), kept AS (
      SELECT * FROM scored s
      WHERE NOT EXISTS (SELECT 1 FROM f x WHERE x.lang = s.lang AND x.words > s.words AND 100 * x.f >= 100 * s.a
                        AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' '))
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))
