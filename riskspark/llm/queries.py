"""One query for each operator, with its production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import (anchors, centroids, idfiles, labeller, lines, packing, periods, quality,
                           sharding, simhash, templates, tokencount, topk)
from riskspark.llm.slots import LEAST_BUCKETS, ROWS_PER_BUCKET
from riskspark.llm.tokens import public_path
from riskspark.session import work_path

SHARDS = 24
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards by jump consistent hashing of its id."""
    return sharding.assign_shards(_read(spark, sf_dir, "documents"), SHARDS)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in ten documents or more."""
    kept = lines.drop_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    packed = packing.pack_documents(_read(spark, sf_dir, "documents"), public_path(BYTE_BPE))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score for every document."""
    return quality.fit_and_score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, one row for each document and item."""
    return templates.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"),
                                  by_window=True)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return labeller.extract(_read(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to coded files, and what is read back from them."""
    path = work_path(spark, "ids")
    idfiles.write_ids(_read(spark, sf_dir, "documents"), public_path(BYTE_BPE), path)
    return idfiles.read_ids(spark, path)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates of each twentieth vector."""
    return topk.exact_top(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencount.count_tokens(_read(spark, sf_dir, "documents"), public_path(WORD_BPE))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Ids and texts; of each tenth document by the checksum of its id, the end is made periodic.

    From word a on, the text repeats the p words there. A null id or text is left as it is.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    checksum = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(checksum / 10).cast("bigint")
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = (F.floor((n - a) / p) + 1).cast("int")
    periodic = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return docs.select("doc_id", F.when(
        (checksum % 10 == 0) & F.col("text").isNotNull() & (n > 0),
        F.array_join(F.concat(F.slice(words, F.lit(1), a), periodic), " "))
        .otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, and the digest of its words without repeated periods."""
    docs = with_planted_periods(_read(spark, sf_dir, "documents"))
    return periods.run_digests(periods.collapse_runs(docs))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that a smaller document has."""
    kept = anchors.drop_repeats(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)
                       .alias("kept_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector after three rounds."""
    return centroids.centroid_clusters(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_sharding, op2_line_dedup, op3_packing, op4_quality, op5_simhash, op6_decontamination,
    op7_html_extraction, op8_token_files, op9_top_k, op10_token_counts,
    op11_periodic_runs, op12_substring_dedup, op13_centroids)}

_SHARDING_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)),
      lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
docs AS (
  SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents),
crcs AS (
  SELECT doc_id, d, strlen(text) + 8 AS size,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(text)), '..'),
                                               lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM docs, crc_table),
jumps AS (
  SELECT doc_id, ('0x' || substr(d, 1, 16))::UBIGINT::HUGEINT AS k, 0::HUGEINT AS j,
         0::HUGEINT AS b, 0::HUGEINT AS g FROM docs
  UNION ALL
  SELECT doc_id, k2, floor((j + 1)::DOUBLE * (2147483648.0 / ((k2 // 8589934592) + 1)::DOUBLE))::HUGEINT,
         CASE WHEN j < {SHARDS} THEN j ELSE b END, j
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jumps
        WHERE j <= {SHARDS})),
ends AS (SELECT doc_id, max(b) AS shard, max(g) AS grown FROM jumps GROUP BY doc_id),
n AS (SELECT {LEAST_BUCKETS} + count(*) // {ROWS_PER_BUCKET} AS buckets FROM documents)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard
         ORDER BY ('0x' || substr(d, 17, 8))::BIGINT % buckets, doc_id) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM crcs JOIN ends USING (doc_id), n"""

_LINES_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN c.key IS NULL THEN line END, chr(10) ORDER BY pos), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY doc_id"""

_TOP_SQL = """
WITH fit AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM fit q JOIN fit c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored) WHERE rank <= 20"""

_SUBSTRING_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(doc_id, -9223372036854775808) AS id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT r, id, unnest(range(len(words) - 49)) AS s, words FROM docs WHERE len(words) >= 50),
hashed AS (SELECT r, id, s, md5(array_to_string(words[s + 1:s + 50], ' ')) AS h FROM windows),
later AS (SELECT r, s FROM (SELECT *, min(id) OVER (PARTITION BY h) AS first FROM hashed) WHERE id > first),
gone AS (SELECT r, list(DISTINCT place) AS places FROM (SELECT r, unnest(range(s, s + 50)) AS place FROM later)
         GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_transform(
         list_filter(range(len(words)), lambda i: NOT list_contains(places, i)),
         lambda i: words[i + 1]) END, ' '), ''))
         AS kept_sha256
FROM docs LEFT JOIN gone USING (r)"""


def _centroids_sql(rounds: int = centroids.ROUNDS) -> str:
    """Each round spelled out: distances, the nearest centroid, floors of the means."""
    steps = [f"""
WITH fit AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {centroids.WIDTH}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v
  FROM (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM fit
        ORDER BY h, v LIMIT {centroids.CLUSTERS}))"""]
    for at in range(rounds + 1):
        steps.append(f"""
a{at} AS (
  SELECT r, k, d FROM (
    SELECT r, k, d, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM (
      SELECT r, k, CAST(list_sum(list_transform(list_zip(fit.v, c{at}.v),
                                 lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
      FROM fit, c{at})) WHERE place = 1)""")
        if at < rounds:
            steps.append(f"""
m{at} AS (
  SELECT k, list(CAST((total - ((total % n) + n) % n) / n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT k, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM (
      SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM fit JOIN a{at} USING (r))
    GROUP BY k, i) GROUP BY k),
c{at + 1} AS (SELECT k, coalesce(m{at}.v, c{at}.v) AS v FROM c{at} LEFT JOIN m{at} USING (k))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM fit JOIN a{rounds} USING (r) JOIN c{rounds} c USING (k)"""


ORACLES = {"op1_sharding": _SHARDING_SQL, "op2_line_dedup": _LINES_SQL, "op9_top_k": _TOP_SQL,
           "op12_substring_dedup": _SUBSTRING_SQL, "op13_centroids": _centroids_sql()}
