"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm.centroids import centroid_clusters
from panelforge.llm.common import table
from panelforge.llm.compact_windows import repeated_passages
from panelforge.llm.hnsw import near_vectors
from panelforge.llm.lm_scoring import lm_scores
from panelforge.llm.mixing import mix_sources, taken_words
from panelforge.llm.ngram_join import jaccard_components
from panelforge.llm.phrases import collocations
from panelforge.llm.quality import quality_verdicts
from panelforge.llm.secrets import secret_digests
from panelforge.llm.sentencepiece import token_ids
from panelforge.llm.sharding import shard_documents
from panelforge.llm.toxicity import toxicity_scores
from panelforge.llm.warc import round_trip


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix_sources(table(spark, sf_dir, "documents")))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"))


def op4_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages")).drop("intact")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mix_sources, op2_ngram_jaccard, op3_sentencepiece, op4_hnsw_near_dedup, op5_warc, op6_quality_rules, op7_secret_scan, op8_toxicity, op9_compact_windows, op10_shards, op11_centroid_clusters, op12_lm_scoring, op13_collocations)}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
), t AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p WHERE 100 * c >= 80 * (nx + ny - c)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS root FROM s UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id WHERE r.root < e.y
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id FROM s JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) m ON s.doc_id = m.doc_id
""",
    "op5_warc": r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f
""",
    "op11_centroid_clusters": r"""
WITH k AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, sha256('1:' || vec_id) AS h FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v AS m FROM k ORDER BY h LIMIT 16
), a0 AS (
  SELECT vec_id, v, arg_min(c, d) AS c, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + c AS d FROM k, c0) GROUP BY vec_id, v
), s0 AS (
  SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, 65)) AS j FROM a0) GROUP BY c, j
), u0 AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s0 GROUP BY c
), c1 AS (
  SELECT o.c, coalesce(u.m, o.m) AS m FROM c0 o LEFT JOIN u0 u ON o.c = u.c
), a1 AS (
  SELECT vec_id, v, arg_min(c, d) AS c, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + c AS d FROM k, c1) GROUP BY vec_id, v
), s1 AS (
  SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, 65)) AS j FROM a1) GROUP BY c, j
), u1 AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s1 GROUP BY c
), c2 AS (
  SELECT o.c, coalesce(u.m, o.m) AS m FROM c1 o LEFT JOIN u1 u ON o.c = u.c
), a2 AS (
  SELECT vec_id, v, arg_min(c, d) AS c, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + c AS d FROM k, c2) GROUP BY vec_id, v
), s2 AS (
  SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, 65)) AS j FROM a2) GROUP BY c, j
), u2 AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s2 GROUP BY c
), c3 AS (
  SELECT o.c, coalesce(u.m, o.m) AS m FROM c2 o LEFT JOIN u2 u ON o.c = u.c
), a3 AS (
  SELECT vec_id, v, arg_min(c, d) AS c, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + c AS d FROM k, c3) GROUP BY vec_id, v
)
SELECT vec_id, a.c AS cluster, CAST(d // 16 AS BIGINT) AS distance, CAST(sum(d // 16) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d // 16) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a3 a JOIN c3 m ON a.c = m.c
""",
    "op13_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), c AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 6) s(size)) GROUP BY ALL
), t AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE size = 1 GROUP BY lang
), k AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE size > 1 AND f >= 100
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i FROM k, range(2, 5) s(m) WHERE m < size)
), cuts AS (
  SELECT k.lang, k.phrase, k.a, t.n, i, l.f AS l, r.f AS r, (1000 * k.a::HUGEINT * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS i FROM k) k JOIN t ON t.lang = k.lang
  JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:i], ' ') JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[i + 1:], ' ')
  WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = k.lang AND x.phrase = k.phrase AND x.a >= k.a)
), best AS (
  SELECT lang, phrase, a, n, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM best
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""",
}
