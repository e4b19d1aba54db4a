"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, class_model, decontamination, exact_dedup, language_id, lexical, packing, sharding, simhash, substring_dedup, token_counts, token_files, url_filter
from .common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge_urls(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(_table(spark, sf_dir, "documents"), 24)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    return out.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_model.score_documents(_table(spark, sf_dir, "documents"), language_id.held_out(10, 0))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = language_id.identify_languages(docs, docs.where(~language_id.held_out()).select("text", "lang"))
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_documents(_table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    f.__name__: f
    for f in (op1_url_filter, op2_sharding, op3_substring_dedup, op4_class_model, op5_token_counts, op6_language_id, op7_decontamination)
    + (op8_simhash, op9_exact_dedup, op10_packing, op11_centroids, op12_lexical_search, op13_token_files)
}

_OP1 = r"""
WITH r AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
s AS (SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM r),
t AS (SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM s)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM t
"""

_OP9 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

_OP7 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, unnest([array_to_string(words[i:i + least(len(words), 10) - 1], ' ') FOR i IN range(1, greatest(len(words) - 9, 1) + 1)]) AS win FROM b WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, greatest(len(words) - n + 1, 0) + 1)) AS i, words FROM w, sizes),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.win = array_to_string(words[i:i + dw.n - 1], ' ')),
p AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""



def _op11(rounds: int = 10) -> str:
    """Rounds of assignment (a) and floored means (c), one common table each; components stand in rows."""
    nearest = """a{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM
  (SELECT vec_id, k, sum((x - y) * (x - y))::BIGINT AS dist FROM e JOIN c{r} USING (i) GROUP BY vec_id, k) GROUP BY vec_id)"""
    moved = """c{n} AS MATERIALIZED (SELECT k, i, coalesce(z, y) AS y FROM c{r} LEFT JOIN
  (SELECT k, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS z FROM (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM e JOIN a{r} USING (vec_id) GROUP BY k, i)) USING (k, i))"""
    steps = [x.format(r=r, n=r + 1) for r in range(rounds) for x in (nearest, moved)]
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
e AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS i, floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM v),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM v QUALIFY k < 8),
c0 AS MATERIALIZED (SELECT k, i, x AS y FROM e JOIN s USING (vec_id)),
{", ".join(steps)}, {nearest.format(r=rounds)},
h AS (SELECT k, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k AS cluster, dist AS distance, sum(dist) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(dist) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN h USING (k)
"""


_OP12 = r"""
WITH t AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text,
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents) GROUP BY doc_id, term),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
d AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM t GROUP BY term), a),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN d USING (doc_id), a GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""

ORACLE_SQL = {"op1_url_filter": _OP1, "op7_decontamination": _OP7, "op9_exact_dedup": _OP9, "op11_centroids": _op11(), "op12_lexical_search": _OP12}
