"""The driver's queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlematch.llm.base import table
from titlematch.llm.exact_dedup import exact_groups
from titlematch.llm.jaccard_join import jaccard_classes
from titlematch.llm.mixing import mix
from titlematch.llm.near_dedup import near_classes
from titlematch.llm.packing import packed
from titlematch.llm.prefix_trie import prefix_trie
from titlematch.llm.quality import quality_scores
from titlematch.llm.resampling import resampled
from titlematch.llm.secrets import secrets
from titlematch.llm.token_counts import token_counts
from titlematch.llm.topk_search import top_scores
from titlematch.llm.toxicity import toxicity
from titlematch.llm.training_order import training_order


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"), words=2)


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(table(spark, sf_dir, "embeddings"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_secrets, op3_source_mix, op4_token_counts, op5_best_fit_packing, op6_toxicity, op7_quality, op8_near_dedup, op9_training_order, op10_top_k, op11_prefix_trie, op12_resampling, op13_jaccard_join)}

_WORDS = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
_ASSIGN = rf"""(?:{_WORDS}|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_NEAR = "x.n = y.n AND x.a <= y.e + 256 AND x.e >= y.a - 256"

# CRC-32 of a byte list, with the table of the polynomial worked out in place.
_CRC_TABLE = """g(n, k, c) AS (
  SELECT range, 0, range FROM range(256) UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM g WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY n) AS tab FROM g WHERE k = 8)"""


def _crc(text: str) -> str:
    data = f"list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex({text}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    fold = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))"
    return f"xor({fold}, CAST(4294967295 AS BIGINT))"


ORACLE_SQL = {
    "op11_prefix_trie": f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text,
    sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, token) AS pos, token, length(text) AS n FROM t),
i AS (SELECT c, c - c % 100 AS family, {_crc("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM o), crc_table),
r AS (
  SELECT i.c, 0 AS own, o.pos, o.token, o.n FROM i JOIN o ON o.c = i.family AND o.pos <= i.h
  UNION ALL
  SELECT i.c, 1, o.pos, o.token, o.n FROM i JOIN o ON o.c = i.c AND o.pos > i.h
), d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth, token, n FROM r),
p AS (
  SELECT c, depth, n, string_agg(token, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM d
  UNION ALL
  SELECT c, 0, 0, '' FROM i
), e AS (SELECT c, max(depth) AS last FROM p GROUP BY c),
m AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = last) AS ends
  FROM p JOIN e USING (c) GROUP BY path, depth
), k AS (SELECT substr(path, 1, 64 * (depth - 1)) AS path, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1),
x AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k USING (path)),
u AS (SELECT substr(path, 1, 64 * a) AS path, n_children, (n_convs - 1) * n AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM x)),
s AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM u GROUP BY path)
SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM x JOIN s USING (path) LEFT JOIN x AS y ON x.depth > 0 AND y.path = substr(x.path, 1, 64 * (x.depth - 1))
""",
    "op12_resampling": rf"""
WITH RECURSIVE {_CRC_TABLE},
w AS (
  SELECT true AS own, row_number() OVER () AS n, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT false, row_number() OVER (), NULL, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), f AS (
  SELECT own, n, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w
), c AS (SELECT own, n, f, count(*) AS k FROM f GROUP BY ALL),
d AS (SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM c), crc_table),
b AS (SELECT own, n, bucket, sum(k) AS k FROM c JOIN d USING (f) GROUP BY ALL),
t AS (
  SELECT bucket, coalesce(sum(k) FILTER (own), 0) AS s, coalesce(sum(k) FILTER (NOT own), 0) AS t FROM b GROUP BY bucket
), z AS (SELECT CAST(sum(s) AS DOUBLE) AS big_s, CAST(sum(t) AS DOUBLE) AS big_t FROM t),
a AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (big_s + 10000) / ((CAST(s AS DOUBLE) + 1) * (big_t + 10000)))) AS BIGINT) AS gain FROM t, z
), m AS (SELECT n, CAST(sum(k) AS BIGINT) AS n_features, sum(k * gain) AS total FROM b JOIN a USING (bucket) WHERE own GROUP BY n),
s AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
    CAST(coalesce(floor(CAST(total AS DOUBLE) / n_features), 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN m USING (n) WHERE own
), r AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM s),
q AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
  FROM r
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM q
""",
    "op2_secrets": rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
k(rank, kind, pattern) AS (VALUES (1, 'assign', '{_ASSIGN}'), (2, 'access', 'AKIA[A-Z0-9]{{12,}}'), (3, 'hex', '[0-9a-f]{{32,}}'),
  (4, 'secret', '[A-Za-z0-9+/]{{40,}}'), (5, 'endpoint', 'https?://[^\x20\x09-\x0D"''<>]+')),
m AS (SELECT n, rank, kind, regexp_extract_all(text, pattern) AS own, string_split_regex(text, pattern) AS gap FROM d, k),
p AS (SELECT *, unnest(generate_series(1, len(own))) AS i FROM m),
s AS (
  SELECT n, rank, kind, own[i] AS t, CAST(list_sum(list_transform(gap[1:i], lambda g: length(g)))
    + coalesce(list_sum(list_transform(own[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS a FROM p
), c AS (
  SELECT n, rank, kind, a, a + length(t) AS e FROM s
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(t, '{_ASSIGN}', 1)) >= 8
    WHEN 'secret' THEN regexp_full_match(t, '[A-Za-z0-9+/]{{40}}') AND regexp_matches(t, '[A-Z]')
      AND regexp_matches(t, '[a-z]') AND regexp_matches(t, '[0-9]')
    ELSE true END
), f AS (
  SELECT * FROM c AS y WHERE kind = 'access' AND EXISTS (SELECT 1 FROM c AS x WHERE x.kind IN ('secret', 'assign') AND {_NEAR})
), l AS (
  SELECT * FROM c WHERE rank <= 3
  UNION ALL
  SELECT * FROM c AS y WHERE kind = 'secret' AND EXISTS (SELECT 1 FROM c AS x WHERE x.kind = 'access' AND {_NEAR})
  UNION ALL
  SELECT * FROM c AS y WHERE kind = 'endpoint' AND EXISTS (SELECT 1 FROM f AS x WHERE {_NEAR})
), g AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) FILTER (rank <= 3) AS base,
    string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) AS spans
  FROM l GROUP BY n
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON g.n = d.n
""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op1_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
""",
    "op8_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(
    list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w
), n AS (SELECT doc_id, len(s) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM x AS a JOIN x AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM c JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
  WHERE 100 * hits >= 80 * (p.n_shingles + q.n_shingles - hits)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m ON m.a = doc_id
""",
    "op13_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')] ELSE list_distinct(
    list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), n AS (SELECT doc_id, len(s) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM x AS a JOIN x AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM c JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
  WHERE 100 * hits >= 90 * (p.n_shingles + q.n_shingles - hits)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n_shingles, component_id FROM n JOIN m ON m.a = doc_id
""",
    "op3_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS g
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM s
  WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM w
), f AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS n FROM t
), b AS (
  SELECT d.doc_id, d.size, d.source, f.source_size, f.target, f.n, f.target - f.n * f.source_size AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.g ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, source_size, target, copies, copies * size AS taken
FROM (
  SELECT *, CASE WHEN size = 0 THEN 0
    ELSE n + CASE WHEN upto <= budget OR 2 * (budget - (upto - size)) > size AND upto - size <= budget THEN 1 ELSE 0 END END AS copies
  FROM b
)
""",
}
