"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import decontaminate as bench
from snapflow.llm import (
    filter_audit,
    hard_negatives,
    html_extract,
    language,
    line_crf,
    line_dedup,
    odd_sketch,
    packing,
    quality_rules,
    simhash,
    token_count,
    url_filter,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: The rules that the query is to apply.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict_language(docs, language.training_samples(docs))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.url_filter(read(spark, sf_dir, "pages"), rules)


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents")).drop("dropped_lines", "text_hash")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bench.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(read(spark, sf_dir, "documents")).drop("root")


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return line_crf.score_quality(docs, line_crf.learn_quality(docs, labels))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op11_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, scale=256.0)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_url_filter": op4_url_filter,
    "op5_token_count": op5_token_count,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_crf": op7_line_crf,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_odd_sketch": op11_odd_sketch,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op6_quality_rules"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), spots AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM docs WHERE len(w) > 4
), marked AS (
  SELECT doc_id, i,
         count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS n FROM spots
), again AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
  FROM marked, (SELECT unnest(range(5)) AS d) WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs
), worded AS (
  SELECT *, array_to_string(regexp_extract_all(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), ' ') AS normal,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id
), hosts AS (
  SELECT source, count(DISTINCT text) AS docs FROM docs GROUP BY source
), often AS (
  SELECT source, normal FROM (
    SELECT source, normal, count(DISTINCT text) AS n FROM worded GROUP BY source, normal
  ) JOIN hosts USING (source) WHERE n > 20 AND 100 * n > 5 * docs
), lost AS (
  SELECT doc_id, sum(n) AS gone FROM worded SEMI JOIN often USING (source, normal) GROUP BY doc_id
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(w) - coalesce(gone, 0) AS BIGINT) AS words_left
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN again USING (doc_id)
  LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, words_left,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND words_left >= 10 AND 100 * words_left >= 30 * n_words AS kept
FROM counted
"""

LLM_ORACLE["op9_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + 12], ' ') AS line
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM items WHERE len(w) > 0)
), spots AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS line
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, i, size, item_id FROM spots JOIN windows USING (size, line)
), counted AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, size FROM hits), (SELECT unnest(range(13)) AS d)
  WHERE d < size GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

LLM_ORACLE["op4_url_filter"] = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
         ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), found AS (
  SELECT url, unnest(regexp_extract_all(html,
           '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')) AS tag FROM pages
), targets AS (
  SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM found
), ways AS (
  SELECT split_part(url, '#', 1) AS a, split_part(target, '#', 1) AS b FROM targets
  UNION SELECT split_part(target, '#', 1), split_part(url, '#', 1) FROM targets
), urls AS (
  SELECT DISTINCT url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM (SELECT url FROM pages UNION SELECT a FROM ways)
), fits AS (
  SELECT url, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
   AND starts_with(u.path, r.path) GROUP BY url
), heard(url, verdict) AS (
  SELECT a, verdict FROM (SELECT DISTINCT a FROM ways) JOIN fits ON a = url
  UNION
  SELECT b, verdict FROM heard JOIN ways ON url = a
), aliases AS (
  SELECT url, min(verdict) AS verdict FROM heard GROUP BY url
)
SELECT page_id, u.host, u.path, f.rule, coalesce(f.verdict, a.verdict, 'allow') AS verdict
FROM pages p JOIN urls u ON p.url IS NOT DISTINCT FROM u.url
LEFT JOIN fits f ON p.url = f.url LEFT JOIN aliases a ON split_part(p.url, '#', 1) = a.url
"""

LLM_ORACLE["op12_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS copy FROM docs
), known AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good,
         max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(w) < 100 AS INT) AS a,
         CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT) AS b,
         CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS INT) AS c,
         CAST(regexp_matches(text, '[#$%&*|]') AS INT) AS d,
         CAST(copy AS INT) AS e
  FROM split LEFT JOIN known USING (doc_id)
), masks AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
         sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order,
         [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

LLM_ORACLE["op13_hard_negatives"] = r"""
WITH fine AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, r.v),
           lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
  FROM fine a JOIN fine r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                               ORDER BY score DESC, other) AS INT) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""

LLM_ORACLE["op11_odd_sketch"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), nodes AS (
  SELECT array_to_string(w, ' ') AS line, min(doc_id) AS node, any_value(w) AS w
  FROM docs WHERE len(w) > 0 GROUP BY 1
), grams AS (
  SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT node, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM nodes)
), sizes AS (
  SELECT node, count(*) AS n FROM grams GROUP BY node
), pairs AS (
  SELECT x.node AS a, y.node AS b, count(*) AS n_both
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.node < y.node GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes s ON a = s.node JOIN sizes t ON b = t.node
  WHERE 100 * n_both >= 85 * (s.n + t.n - n_both)
), ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(node, other) AS (
  SELECT a, b FROM ways UNION SELECT node, b FROM reached JOIN ways ON other = a
), roots AS (
  SELECT node, min(other) AS other FROM reached GROUP BY node
)
SELECT doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles,
       least(coalesce(n.node, doc_id), coalesce(r.other, n.node, doc_id)) AS component_id,
       least(coalesce(n.node, doc_id), coalesce(r.other, n.node, doc_id)) = doc_id AS kept
FROM docs d LEFT JOIN nodes n ON len(d.w) > 0 AND array_to_string(d.w, ' ') = n.line
LEFT JOIN sizes s ON n.node = s.node LEFT JOIN roots r ON n.node = r.node
"""
