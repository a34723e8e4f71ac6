"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mvtax.llm import (conversations, exact_dedup, mixing, ngram_rules, packing, periodic, quality, simhash, spotsigs, substring,
                       token_count, toxicity, url_filter)

#: (host, path, verdict) of op8
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.best_fit_pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_likeness(_table(spark, sf_dir, "documents"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse_runs(_table(spark, sf_dir, "documents"), periodic.planted_period)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_token_count": op4_token_count,
    "op5_substring": op5_substring,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_fingerprints": op10_fingerprints,
    "op11_conversations": op11_conversations,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic": op13_periodic,
}

ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op8_url_filter": """
        WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS raw,
                          coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
             h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
             rules(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                                   ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
             fits AS (SELECT page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS n
                      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
        SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
        FROM h LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (page_id)
    """,
    # crc32 by bytes (three words of its table in one list), then the cost vectors backward, then the walk forward
    "op11_conversations": """
        WITH RECURSIVE bits(i, c, n) AS (
            SELECT i, CAST(i AS BIGINT), 0 FROM range(256) r(i) UNION ALL
            SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
        crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
        keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        hashed AS (SELECT conv_id, turn, role, text,
                          xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
                                          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
        damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
                    FROM hashed, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                        count(*) OVER (PARTITION BY conv_id) AS n FROM placed),
        rows AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
                               WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault, role[1] AS r FROM seen),
        facts AS (SELECT *, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS more FROM rows),
        back(conv_id, i, v0, v1, v2, v3) AS (
            SELECT conv_id, max(n) + 1, 0, 4, 2, 0 FROM facts GROUP BY conv_id UNION ALL
            SELECT conv_id, i, least(d0, 2 + c2, 2 + 2 + c3), least(d1, 2 + c2, 2 + 2 + c3), least(c2, 2 + c3), least(c3, 2 + c2), FROM (
                SELECT b.conv_id, f.i, CASE WHEN gone THEN 3 + v0 ELSE least(3 + v0, 2 + more + v2, CASE r WHEN 's' THEN more + v1 WHEN 'u' THEN more + v2 ELSE 1000000 END) END AS d0,
                       CASE WHEN gone THEN 3 + v1 ELSE least(3 + v1, 2 + more + v2, CASE r WHEN 'u' THEN more + v2 ELSE 1000000 END) END AS d1,
                       CASE WHEN gone THEN 3 + v2 ELSE least(3 + v2, 2 + more + v3, CASE r WHEN 'a' THEN more + v3 ELSE 1000000 END) END AS c2,
                       CASE WHEN gone THEN 3 + v3 ELSE least(3 + v3, 2 + more + v2, CASE r WHEN 'u' THEN more + v2 ELSE 1000000 END) END AS c3
                FROM back b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1)),
        cost AS (SELECT conv_id, i, [v0, v1, v2, v3] AS v FROM back),
        walk(conv_id, i, s, audit, said, n) AS (
            SELECT conv_id, CAST(1 AS BIGINT), 0, '', [''][1:0], max(n) FROM facts GROUP BY conv_id UNION ALL
            SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN s WHEN 'K' THEN CASE r WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE grow END, audit || e,
                   CASE e WHEN 'D' THEN said WHEN 'K' THEN list_append(said, role || ':' || text)
                          ELSE list_append(said, CASE grow WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE e WHEN 'I' THEN '' ELSE text END) END, n
            FROM (SELECT w.*, f.role, f.text, f.r, CASE w.s WHEN 2 THEN 3 ELSE 2 END AS grow,
                         CASE WHEN w.i <= w.n AND 3 + a.v[w.s + 1] = c.v[w.s + 1] THEN 'D' WHEN 2 + c.v[CASE w.s WHEN 2 THEN 4 ELSE 3 END] = c.v[w.s + 1] THEN 'I'
                              WHEN NOT f.gone AND f.more + a.v[CASE WHEN f.r = 's' AND w.s = 0 THEN 2 WHEN f.r = 'u' AND w.s <> 2 THEN 3 WHEN f.r = 'a' AND w.s = 2 THEN 4 END] = c.v[w.s + 1] THEN 'K'
                              WHEN w.i <= w.n THEN 'R' END AS e
                  FROM walk w JOIN cost c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i
                  LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i
                  LEFT JOIN cost a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1) WHERE e IS NOT NULL),
        ended AS (SELECT conv_id, audit, said FROM walk WHERE i = n + 1 AND s IN (0, 3)),
        counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
                           count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
                           count(*) FILTER (WHERE i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(coalesce(c.v[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
               sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN cost c ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND c.i = 1 LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
