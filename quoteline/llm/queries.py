"""Registered queries of the training-data operators, over whole tables, and their SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import (
    ann_search,
    decontamination,
    filter_audit,
    language_id,
    line_dedup,
    near_dedup,
    quality,
    sentencepiece_codec,
    simhash_dedup,
    source_divergence,
    substring_dedup,
    token_counts,
    token_store,
)
from .common import table


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(table(spark, d, "documents"), digest=True)


def op2_ann_search(spark: SparkSession, d: str) -> DataFrame:
    return ann_search.nearest(table(spark, d, "embeddings"))


def op3_token_store(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_tokens(table(spark, d, "documents"), path)
    return token_store.read_documents(spark, path)


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.digests(
        decontamination.find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), null_items=True))


def op5_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(table(spark, d, "documents"))


def op6_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(table(spark, d, "documents"))


def op8_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, d, "documents"))


def op9_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.classes(near_dedup.near_duplicates(table(spark, d, "documents")))


def op10_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentencepiece_codec.round_trip_digests(table(spark, d, "documents"))


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return source_divergence.audit(table(spark, d, "documents"))


def op12_simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, d, "documents"))


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ann_search": op2_ann_search,
    "op3_token_store": op3_token_store,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_source_divergence": op11_source_divergence,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_filter_audit": op13_filter_audit,
}

# Words, the windows of every item and the places where they occur, as lists of words joined by spaces.
_OP4 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
cut AS (
  SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
  FROM b WHERE len(words) > 0
),
pat AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS p FROM cut),
sizes AS (SELECT DISTINCT n FROM pat),
place AS (
  SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS p
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, sizes WHERE len(words) >= n)
),
found AS (SELECT doc_id, item_id, place.n, i FROM place JOIN pat ON place.p = pat.p AND place.n = pat.n),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
),
own AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""

# Every window of 20 words as text, the first place of each, and the words that later ones cover.
_OP8 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win) WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM again),
word AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS j, unnest(words) AS x FROM w),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.j) AS t
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.j = gone.j WHERE gone.j IS NULL GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

# Every kept term of every group, zeros included, joined pair by pair.
_OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (
  SELECT lang, t FROM (SELECT lang, unnest(list_distinct(terms)) AS t FROM d) GROUP BY lang, t HAVING count(*) >= 10
),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (
  SELECT x.lang, source, x.t, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS t FROM d) x
  JOIN kept ON x.lang = kept.lang AND x.t = kept.t GROUP BY x.lang, source, x.t
),
dense AS (
  SELECT g.lang, g.source, kept.t, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, kept.t) AS all_n,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS whole
  FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = kept.t
),
p AS (
  SELECT dense.lang, source, t, n, CAST(1 + 1000000000 * (n + 2) // (own + 2 * v) AS BIGINT) AS p,
         CAST(1 + 1000000000 * (all_n + 2) // (whole + 2 * v) AS BIGINT) AS q
  FROM dense JOIN v ON v.lang = dense.lang
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
"""

# Every document's failures, summed by mask and then for each order and step.
_OP13 = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
marked AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
           FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(x, '[A-Z]')) > 5 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN marked ON marked.doc_id = w.doc_id
),
cell AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31
),
steps AS (SELECT o, s AS step, bits[s] AS own, list_sum(list_slice(bits, 1, s)) - bits[s] AS before
          FROM orders, range(1, 6) r(s)),
told AS (
  SELECT part, o, step, own, sum(CASE WHEN mask & CAST(before + own AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own > 0 AND mask & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own > 0 AND mask & CAST(before AS INTEGER) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own > 0 AND mask & CAST(before AS INTEGER) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own > 0 AND mask & CAST(before AS INTEGER) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, steps GROUP BY part, o, step, own
)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM told
"""

ORACLES: dict[str, str] = {"op4_decontamination": _OP4, "op8_substring_dedup": _OP8, "op11_source_divergence": _OP11,
                           "op13_filter_audit": _OP13}
