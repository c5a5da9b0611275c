"""The registered queries of the corpus operators: thin callers over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontaminate, langid, lexical_search, license_scan, line_dedup, ngram_join, prefix_trie, token_counts, toxicity, url_filter, warc
from .common import LOWER, UPPER, table

# Folder of the public tokenizer files; never copied into the repository.
TOKENIZER_DIR = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that no rule decides carry the label of the document of the same id: block if toxic or of low quality."""
    marks = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), "block").otherwise("allow").alias("verdict"),
    )
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), marks)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(table(spark, sf_dir, "documents"), f"{TOKENIZER_DIR}/byte_bpe_50k.json")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), f"{TOKENIZER_DIR}/word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontaminate": op2_decontaminate,
    "op3_url_filter": op3_url_filter,
    "op4_license_scan": op4_license_scan,
    "op5_ann": op5_ann,
    "op6_bpe": op6_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_counts": op13_token_counts,
}

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = f"'{UPPER}', '{LOWER}'"
_WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


def _terms(text: str) -> str:
    return f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), {_AZ}), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


# DuckDB twins of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        spans AS (
            SELECT DISTINCT item, least(len(w), 13) AS n, unnest(list_transform(
                range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS span
            FROM b WHERE len(w) > 0
        ), lengths AS (SELECT DISTINCT n FROM spans),
        placed AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
                   unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS span
            FROM d, lengths WHERE len(w) >= n
        ), hit AS (SELECT doc_id, i, n, item FROM placed JOIN spans USING (n, span)),
        cover AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN top <> page_id THEN top END AS refers_to
        FROM p LEFT JOIN f USING (d)
    """,
    "op9_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no
            FROM documents
        ), keyed AS (
            SELECT *, trim(translate(line, {_AZ}), {_BLANK}) AS key FROM lines
        ), owners AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner < doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY no)
                               FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
        FROM keyed LEFT JOIN owners USING (key)
        GROUP BY doc_id
    """,
    # CRC-32 bit by bit: each byte is xored in, then eight shifts follow
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY pos) AS s,
                   xor(list_reduce(
                       list_concat([4294967295::BIGINT], flatten(list_transform(
                           string_split(conv_id::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], list_resize([]::BIGINT[], 8, -1::BIGINT))))),
                       lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) % 6 AS h
            FROM turns GROUP BY conv_id
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:c.h], c.s[c.h + 1:]) AS s
            FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
        ), members AS (
            SELECT conv_id, len(s) AS n, unnest(range(0, len(s) + 1)) AS d, s FROM rebuilt
        ), nodes AS (
            SELECT s[1:d] AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
            FROM members GROUP BY path, d
        ), kids AS (
            SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
        ), valued AS (
            SELECT *, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
                   CASE WHEN d > 0 THEN (n_convs - 1) * length(path[d].x) ELSE 0 END AS own
            FROM nodes LEFT JOIN kids USING (path)
        ), totals AS (
            SELECT path[1:a] AS path, sum(leaf)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
            FROM (SELECT path, leaf, own, unnest(range(0, d + 1)) AS a FROM valued) GROUP BY 1
        )
        SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs, coalesce(v.n_children, 0) AS n_children,
               n_leaves, saved_tokens, v.ends_sha256
        FROM valued v JOIN totals USING (path) LEFT JOIN nodes up ON v.d > 0 AND up.path = v.path[1:v.d - 1]
    """,
    "op12_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS w FROM documents),
        size AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
        tfs AS (
            SELECT r, doc_id, n, t, count(*) AS tf
            FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY r, doc_id, n, t
        ), dfs AS (SELECT t, count(*) AS df FROM tfs GROUP BY t),
        items AS (SELECT DISTINCT item_id, unnest({_terms("text")}) AS t FROM benchmark WHERE item_id IS NOT NULL),
        scored AS (
            SELECT item_id, r, doc_id, sum(
                floor(1000 * ln((2 * size.n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * tfs.n * size.n) // size.l)))
            )::BIGINT AS score
            FROM items JOIN dfs USING (t) JOIN tfs USING (t), size GROUP BY item_id, r, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
