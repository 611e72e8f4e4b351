"""Registered queries of the operators, each over its whole table, and the DuckDB SQL where SQL can say the same."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (
    alignment,
    ann,
    bpe,
    chat,
    collisions,
    divergence,
    kdtree,
    langid,
    license,
    neardup,
    packing,
    quality,
    reputation,
)
from newsflow.llm.common import remainder

RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_prefix_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(turns))


ORACLES["op1_prefix_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, 15 + length(role) + length(text) + 2 * length(role || text)
    - length(replace(role || text, '\', '')) - length(replace(role || text, '#', ''))
    + length(role) - length(replace(role, ':', ''))
    + (length(text) - length(replace(text, '</', ''))) // 2 + (length(role) - length(replace(role, '</', ''))) // 2 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, false AS rewrites
FROM marked GROUP BY conv_id
""".replace("\\\\", "\\")


@query
def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    machine = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.score(documents, machine).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


@query
def op4_kdtree_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op4_kdtree_inner_product"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op5_fuzzy_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op6_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.identify(documents, langid.fit(documents)).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "n_outcomes"
    )


ORACLES["op7_host_reputation"] = """
WITH placed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM placed),
marked AS (SELECT *, CASE WHEN rule IS NOT NULL THEN CAST(rule NOT IN ('org/', 'com/fr/') AS INTEGER) END AS bad FROM ruled),
hosts AS (
  SELECT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
    count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM marked GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
s0 AS (SELECT *, (sum(bad) OVER () + 1) / (sum(n) OVER () + 2) AS m, sum(n) OVER () + 2 AS w FROM suffixes),
sr AS (SELECT (sum(n * pow(bad / n - m, 2)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r FROM s0 WHERE n > 0),
sk AS (SELECT CASE WHEN r > 0 THEN greatest(least(1 / r - 1, 1000.0), 1.0) ELSE 1000.0 END AS k FROM sr),
s1 AS (SELECT suffix, (bad + least(k, w) * m) / (n + least(k, w)) AS mean, n + least(k, w) AS w FROM s0, sk),
d0 AS (SELECT d.*, s1.mean AS m, s1.w FROM domains d JOIN s1 USING (suffix)),
dr AS (SELECT (sum(n * pow(bad / n - m, 2)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r FROM d0 WHERE n > 0),
dk AS (SELECT CASE WHEN r > 0 THEN greatest(least(1 / r - 1, 1000.0), 1.0) ELSE 1000.0 END AS k FROM dr),
d1 AS (SELECT domain, (bad + least(k, w) * m) / (n + least(k, w)) AS mean, n + least(k, w) AS w FROM d0, dk),
h0 AS (SELECT h.*, d1.mean AS m, d1.w FROM hosts h JOIN d1 USING (domain)),
hr AS (SELECT (sum(n * pow(bad / n - m, 2)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r FROM h0 WHERE n > 0),
hk AS (SELECT CASE WHEN r > 0 THEN greatest(least(1 / r - 1, 1000.0), 1.0) ELSE 1000.0 END AS k FROM hr),
h1 AS (SELECT host, n, (bad + least(k, w) * m) / (n + least(k, w)) AS mean, n + least(k, w) AS total FROM h0, hk),
h2 AS (SELECT host, n, mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) > 0.5 AS blocked FROM h1)
SELECT page_id, m.host, path, rule, h2.n AS n_outcomes,
  CASE WHEN rule IS NULL THEN CASE WHEN blocked THEN 'block' ELSE 'allow' END WHEN bad = 1 THEN 'block' ELSE 'allow' END AS verdict
FROM marked m JOIN h2 USING (host)
"""


@query
def op8_hyperminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=85)


ORACLES["op8_hyperminhash_near_duplicates"] = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM tokens),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)
"""


@query
def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary)


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = alignment.load_tokenizers(public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    return alignment.align_corpus(table(spark, sf_dir, "documents"), models)


@query
def op12_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLES["op12_collision_counting"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u) USING (vec_id)
JOIN (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u) USING (vec_id)
"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS size, sum(lang_n) AS total FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source
  GROUP BY ALL),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n,
    CAST(1 + (1000000000 * CAST(coalesce(n, 0) + 2 AS HUGEINT)) // (t.total + 2 * size) AS BIGINT) AS p,
    CAST(1 + (1000000000 * CAST(lang_n + 2 AS HUGEINT)) // (l.total + 2 * size) AS BIGINT) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""".replace("\\\\", "\\")
