"""Queries of the training-data operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, decontamination, filter_audit, near_dedup, packing, quality_rules, secrets, sharding, token_counts, url_filters, vector_codes, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op2_warc_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(_table(spark, sf_dir, "pages"), least=1000)
    return found.select(F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "warc_date")


#: The explicit rules of op3.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def labelled_pages() -> Column:
    """Half of the pages, for reports of what a tree that their texts label does on the others (held_out_purity()); the query
    takes the labels of all pages."""
    return F.crc32(F.col("page_id").cast("string")) % 2 == 0


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_pages(_table(spark, sf_dir, "pages"), URL_RULES)


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.every_turn(_table(spark, sf_dir, "conversations"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=40)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_best_fit_packing, op2_warc_converter, op3_url_templates, op4_host_rules, op5_secret_scan, op6_tool_calls, op7_token_counts, op8_quality_trees, op9_winnowing, op10_min_max_hash, op11_label_sharding, op12_filter_audit, op13_vector_codes, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_converter": OP2_SQL, "op4_host_rules": OP4_SQL, "op9_winnowing": OP9_SQL, "op10_min_max_hash": OP10_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": OP13_SQL}


#: Full result of op2. The date is the one that the query's ARC files carry.
OP2_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p
), g AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS best FROM d WHERE payload_bytes >= 1000 GROUP BY 1, 2
)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN g.best > d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.best > d.page_id THEN g.best END AS refers_to,
       d.url AS target_uri, '2024-01-01T00:00:00Z' AS warc_date
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes = g.payload_bytes
"""

#: Counts word by word, then the failure rates of hosts shrunk by each rule's beta prior.
_RATES = ", ".join(f"coalesce(avg({r} / n), 0) AS {r}_m, coalesce(var_pop({r} / n), 0) AS {r}_v" for r in quality_rules.RULES)
_WEIGHTS = ", ".join(f"least(docs, CASE WHEN {r}_v > {r}_m * (1 - {r}_m) * inverse THEN greatest(1.0, {r}_m * (1 - {r}_m) / ({r}_v - {r}_m * (1 - {r}_m) * inverse) - 1) ELSE docs END) AS {r}_w" for r in quality_rules.RULES)
_OVER = " OR ".join(f"({r} + {r}_w * {r}_m) / (n + {r}_w) > least(0.8, {r}_m + greatest(0.1, 3 * sqrt({r}_m * (1 - {r}_m) / ({r}_w + 1))))" for r in quality_rules.RULES)
OP4_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k
  FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, UNNEST(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2))
), h AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, UNNEST([i, i + 1, i + 2]) AS p FROM g WHERE k > 1) GROUP BY r
), c AS (
  SELECT d.r, doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN h ON d.r = h.r
), f AS (
  SELECT *, n_words < 50 AS few_words, 100 * n_repeat_words > 50 * n_words AS repeats, 10 * n_symbols > 3 * n_words AS symbols, 10 * n_dup_lines > n_words AS dup_lines FROM c
), s AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, {', '.join(f'CAST(count(*) FILTER (WHERE {r}) AS DOUBLE) AS {r}' for r in quality_rules.RULES)} FROM f GROUP BY host
), p AS (SELECT coalesce(avg(n), 0) AS docs, coalesce(avg(1 / n), 0) AS inverse, {_RATES} FROM s WHERE n >= 10
), q AS (SELECT *, {_WEIGHTS} FROM p
), v AS (SELECT host, n >= 10 AND ({_OVER}) AS host_failed FROM s, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed, host_failed, NOT (few_words OR repeats) AND NOT host_failed AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Every window of an item, looked up in every window of a document.
OP9_SQL = rf"""
WITH i AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS n, UNNEST(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), dw AS (
  SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS k
  FROM (SELECT r, w, n, UNNEST(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), m AS (SELECT dw.r, dw.n, dw.s, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k
), h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, UNNEST(range(s, s + n)) AS p FROM m) GROUP BY r
), t AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN t ON d.r = t.r
"""

#: All pairs that share a shingle, and every document's least reachable one.
OP10_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS x FROM (SELECT doc_id, w, UNNEST(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (SELECT doc_id AS id, doc_id AS low FROM d UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.id WHERE r.low < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, q.low AS component_id, q.low = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(low) AS low FROM r GROUP BY id) q ON q.id = d.doc_id
"""

#: Failing filters of every document, counted for every order and step.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents
), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(least < d.doc_id, false)] AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails
), i AS (SELECT UNNEST(range(1, 6)) AS i
), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS (SELECT o, step, o[step] AS own, o[1 : step - 1] AS earlier FROM o, (SELECT i AS step FROM i)
), r AS (
  SELECT part, o, step, own, n, good, toxic, fails[own] AS failed, len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) = 1 AS alone FROM c, s
), g AS (
  SELECT part, o, step, own, coalesce(sum(n) FILTER (WHERE NOT failed AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE failed AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE failed AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failed AND alone), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE failed AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE failed AND NOT gone), 0) AS toxic_lost
  FROM r GROUP BY part, o, step, own
)
SELECT part, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""

#: Every part of every vector against every entry.
_NEAREST = """SELECT r, p, x, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
    SELECT v.r, v.p, v.x, c.e, CAST(list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS BIGINT) AS d FROM v JOIN {codes} c ON v.p = c.p) GROUP BY r, p, x"""
_MEANS = """SELECT c.p, c.e, coalesce(s.x, c.x) AS x FROM {codes} c LEFT JOIN (
    SELECT p, e, list(((t % n) + n) % n ORDER BY i) AS rest, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT p, e, i, sum(x[i]) AS t, count(*) AS n FROM (SELECT p, e, x, UNNEST(range(1, len(x) + 1)) AS i FROM {nearest}) GROUP BY p, e, i) GROUP BY p, e
  ) s ON c.p = s.p AND c.e = s.e"""
OP13_SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (SELECT r, p, x[p * len(x) // 16 + 1 : (p + 1) * len(x) // 16] AS x FROM k, (SELECT UNNEST(range(16)) AS p)
), c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM v WHERE r <= 64
), n1 AS MATERIALIZED ({_NEAREST.format(codes="c0")}
), c1 AS MATERIALIZED ({_MEANS.format(codes="c0", nearest="n1")}
), n2 AS MATERIALIZED ({_NEAREST.format(codes="c1")}
), c2 AS MATERIALIZED ({_MEANS.format(codes="c1", nearest="n2")}
), n3 AS MATERIALIZED ({_NEAREST.format(codes="c2")}
), q AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM n3 GROUP BY r
), h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN q ON k.r = q.r, h
"""
