"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescope.llm import (bpe, chat, lexical, minhash_dedup, packing, pii, prefix_trie, quality_rules, secret_scan,
                            token_store, topk, url_filter, warc)
from tablescope.llm.runtime import show_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return show_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_packages(warc.write_packages(table(spark, sf_dir, "pages")))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  special=True)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_store.write_store(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     special=True)
    return token_store.read_store(shards).withColumnRenamed("id", "doc_id")


# The rules that op7 judges by.
URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transcripts of all conversations, parsed by a model of their rows."""
    found = chat.raw_transcripts(table(spark, sf_dir, "conversations"))
    return chat.parse(found.drop("role"), chat.fit(found))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op10_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_token_store": op6_token_store,
    "op7_url_filter": op7_url_filter,
    "op8_chat_format": op8_chat_format,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii_crf": op10_pii_crf,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op7_url_filter": """
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        p AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        r AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM p)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM r""",
    "op9_quality_rules": rf"""
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM t),
        g AS (
            SELECT r, unnest(range(1, len(words) - 3)) AS i,
                   unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS win
            FROM w WHERE len(words) >= 5),
        d AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1),
        c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM d, range(0, 5) AS x(k) GROUP BY r),
        m AS (
            SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
                   len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in quality_rules.STOP_WORDS)}))) AS n_stop
            FROM w LEFT JOIN c USING (r)),
        b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
               NOT base_failed AND word_chars BETWEEN 2 * n_words AND 20 * n_words
               AND n_symbols <= 0.25 * n_words AND (n_words < {quality_rules.SHARE_WORDS} OR n_stop >= 0.02 * n_words)
               AND n_dup_lines <= 0.5 * n_lines AS kept
        FROM b""",
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS dig,
                   length(coalesce(text, '')) AS chars, turn
            FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) - 1 AS pos FROM t),
        c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base,
                   -- CRC-32 of the decimal id, bit by bit
                   xor(list_reduce([4294967295] || list_transform(range(0, 8 * length(CAST(conv_id AS VARCHAR))),
                           lambda k: (ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 + 1 AS INTEGER), 1)) >> CAST(k % 8 AS INTEGER)) & 1),
                       lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM t)),
        r AS (
            SELECT c.conv_id, 1 AS part, n.pos, dig, chars FROM c JOIN n ON n.conv_id = c.base AND n.pos < c.h
            UNION ALL SELECT c.conv_id, 2, n.pos, dig, chars FROM c JOIN n ON n.conv_id = c.conv_id AND n.pos >= c.h),
        s AS (
            SELECT conv_id, coalesce(list(dig ORDER BY part, pos) FILTER (dig IS NOT NULL), []) AS digs,
                   coalesce(list(chars ORDER BY part, pos) FILTER (dig IS NOT NULL), []) AS chars
            FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
        p AS (
            SELECT conv_id, d, len(digs) = d AS ends, sha256(array_to_string(digs[1:d], ',')) AS prefix,
                   CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars
            FROM s, unnest(range(0, len(digs) + 1)) AS x(d)),
        v AS (
            SELECT d, prefix, min(conv_id) AS node, count(*) AS n_convs, any_value(chars) AS chars,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM p GROUP BY d, prefix),
        m AS (SELECT conv_id, p.d, node FROM p JOIN v USING (d, prefix)),
        u AS (
            SELECT v.*, m.node AS parent, EXISTS (SELECT 1 FROM m AS a JOIN m AS b ON a.conv_id = b.conv_id AND b.d = a.d + 1
                                                  WHERE a.node = v.node AND a.d = v.d) AS inner_node
            FROM v LEFT JOIN m ON m.conv_id = v.node AND m.d = v.d - 1),
        k AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM u WHERE d > 0 GROUP BY parent, d),
        g AS (
            SELECT m.node, m.d, count_if(NOT u.inner_node) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens
            FROM u JOIN m ON m.conv_id = u.node AND m.d <= u.d GROUP BY m.node, m.d)
        SELECT u.node AS conv_id, CAST(u.d AS BIGINT) AS depth, u.parent AS parent_conv_id, u.n_convs,
               coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
        FROM u JOIN g ON g.node = u.node AND g.d = u.d LEFT JOIN k ON k.node = u.node AND k.d = u.d""",
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        q AS (
            SELECT row_number() OVER () AS q, item_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        z AS (SELECT count(*) AS docs, sum(len(terms)) AS words FROM d WHERE len(terms) > 0),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, z GROUP BY term, docs),
        m AS (SELECT r, doc_id, 100 - 75 + CAST((75 * len(terms) * docs) // words AS BIGINT) AS m FROM d, z WHERE len(terms) > 0),
        s AS (
            SELECT q, item_id, r, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM (SELECT q, item_id, unnest(terms) AS term FROM q) JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r)
            GROUP BY q, item_id, r, doc_id),
        o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS n FROM s WHERE score > 0)
        SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM o WHERE n <= 10""",
}
