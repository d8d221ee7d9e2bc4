"""Queries opN_<name> over whole tables, and their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, fingerprints, language, licenses, mixing, neardup, pages, prefix_trie, quality, tokens, toxicity, vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.report(_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.report(_table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(_table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(_table(spark, sf_dir, "embeddings"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.report(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_mix_sources, op2_fingerprints, op3_language_id, op4_decontaminate, op5_ngram_jaccard, op6_license_scan, op7_toxicity, op8_main_text, op9_token_counts, op10_quality, op11_prefix_trie, op12_vector_codes, op13_chat_format)
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS win FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM k)),
ks AS (SELECT DISTINCT k FROM k),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN ks WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id""",
    "op5_ngram_jaccard": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM d),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * o >= 80 * (na + nb - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, min(root) AS component FROM r GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id FROM s LEFT JOIN c ON node = doc_id""",
    "op11_prefix_trie": """
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(unicode(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h FROM o GROUP BY conv_id),
t AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT t.conv_id, pos, role, text FROM t JOIN o ON o.conv_id = t.base AND pos <= h UNION ALL SELECT t.conv_id, k + pos - h, role, text FROM t JOIN o ON o.conv_id = t.conv_id AND pos > h),
p AS (SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM c UNION ALL SELECT conv_id, pos, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos), strlen(text) FROM r),
v AS (SELECT path, depth, substr(path, 1, greatest(length(path) - 64, 0)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY path, depth),
k AS (SELECT up, count(*) AS n FROM v WHERE depth > 0 GROUP BY up),
w AS (SELECT v.*, coalesce(k.n, 0) AS n_children FROM v LEFT JOIN k ON k.up = v.path),
s AS (SELECT p.path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w.bytes) AS saved FROM w JOIN p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.path),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM w JOIN s ON s.path = w.path LEFT JOIN v u ON w.depth > 0 AND u.path = w.up LEFT JOIN e ON e.path = w.path""",
    "op12_vector_codes": """
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS v FROM (SELECT vec_id, v, unnest(range(16)) AS part FROM k)),
b0 AS MATERIALIZED (SELECT part, s.rank AS entry, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS rank FROM k QUALIFY rank < 64) s ON s.vec_id = x.vec_id),
m1 AS MATERIALIZED (SELECT x.vec_id, x.part, min([list_sum(list_transform(list_zip(x.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry]) AS m FROM x JOIN b0 e ON e.part = x.part GROUP BY x.vec_id, x.part),
u1 AS (SELECT part, m[2] AS entry, d, CAST(floor(sum(v[d]) / count(*)) AS BIGINT) AS c FROM (SELECT x.part, m, v, unnest(range(1, len(v) + 1)) AS d FROM x JOIN m1 m ON m.vec_id = x.vec_id AND m.part = x.part) GROUP BY ALL),
n1 AS (SELECT part, entry, list(c ORDER BY d) AS v FROM u1 GROUP BY part, entry),
b1 AS MATERIALIZED (SELECT e.part, e.entry, coalesce(n.v, e.v) AS v FROM b0 e LEFT JOIN n1 n ON n.part = e.part AND n.entry = e.entry),
m2 AS MATERIALIZED (SELECT x.vec_id, x.part, min([list_sum(list_transform(list_zip(x.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry]) AS m FROM x JOIN b1 e ON e.part = x.part GROUP BY x.vec_id, x.part),
u2 AS (SELECT part, m[2] AS entry, d, CAST(floor(sum(v[d]) / count(*)) AS BIGINT) AS c FROM (SELECT x.part, m, v, unnest(range(1, len(v) + 1)) AS d FROM x JOIN m2 m ON m.vec_id = x.vec_id AND m.part = x.part) GROUP BY ALL),
n2 AS (SELECT part, entry, list(c ORDER BY d) AS v FROM u2 GROUP BY part, entry),
b2 AS MATERIALIZED (SELECT e.part, e.entry, coalesce(n.v, e.v) AS v FROM b1 e LEFT JOIN n2 n ON n.part = e.part AND n.entry = e.entry),
m3 AS MATERIALIZED (SELECT x.vec_id, x.part, min([list_sum(list_transform(list_zip(x.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry]) AS m FROM x JOIN b2 e ON e.part = x.part GROUP BY x.vec_id, x.part),
c AS (SELECT vec_id, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM m3 GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM b2)
SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM k JOIN c ON c.vec_id = k.vec_id CROSS JOIN h""",
    "op13_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(regexp_replace(text, '(<)(\\*(?:<SYS>>|</SYS>>|/s>))', '\1\\\2', 'g'), '(\[)(\\*(?:INST\]|/INST\]|ANS\]|TURN\]|SAYS\]|/TURN\]))', '\1\\\2', 'g') AS safe FROM t),
f AS (SELECT *, CASE role WHEN 'system' THEN concat('<<SYS>>', chr(10), safe, chr(10), '<</SYS>>', chr(10), chr(10)) WHEN 'user' THEN concat('[INST] ', safe, ' [/INST]') WHEN 'assistant' THEN concat('[ANS] ', safe, ' </s>')
    ELSE concat('[TURN] ', role, ' [SAYS] ', safe, ' [/TURN]') END AS line,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(length(line)) AS BIGINT) AS formatted_chars,
  count(*) FILTER (NOT (role = 'system' AND before = 'start' OR role = 'user' AND before IN ('start', 'system', 'assistant') OR role = 'assistant' AND before = 'user')) AS n_out_of_order, arg_max(role, i) = 'assistant' AS complete
FROM f GROUP BY conv_id""",
}
