"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster, with_totals
from .decontam import contamination, with_verdict
from .html import extract_main_text
from .langid import identify, train
from .license import license_scan
from .linededup import line_dedup
from .mixing import mix
from .packing import pack
from .quality import quality_scores
from .simhash import simhash_classes
from .substring import substring_dedup
from .vectors import near_vectors
from .whitening import by_component, whiten


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(_load(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    found = identify(docs, model, keep=[F.coalesce(held_out, F.lit(False)).alias("held_out")])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_load(spark, sf_dir, "documents"), cycle=(5, 2, 1), max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup(docs, window=3)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), digest.alias("kept_sha256"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_load(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_load(spark, sf_dir, "documents"), _load(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(_load(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return kept.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_sha256").alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_load(spark, sf_dir, "documents"), threshold=0.8, inside=True)
    return found.select(
        "doc_id",
        F.get("licenses", F.lit(0)).alias("license"),
        F.get("scores", F.lit(0)).alias("dice"),
        F.get("lines", F.lit(0)).alias("line"),
        F.size("licenses").cast("long").alias("n_licenses"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(_load(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_load(spark, sf_dir, "documents"), _load(spark, sf_dir, "benchmark"), window=13)
    return with_verdict(found, share=20).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, made = whiten(_load(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)
    return by_component(rows, made)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(_load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, max_tokens=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_totals(cluster(_load(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed="1"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality": op6_quality,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_html_extraction": op9_html_extraction,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_packing": op12_packing,
    "op13_centroids": op13_centroids,
}


def _centroid_sql(k: int = 16, rounds: int = 3) -> str:
    """Every round as a common table: centroids, nearest centroid of each vector, new centroids."""
    near = """near{r} AS MATERIALIZED (
  SELECT vec_id, min({{'d': d, 'c': c}}) AS m FROM (
    SELECT x.vec_id, c.c, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d
    FROM x JOIN cent{r} c ON x.i = c.i GROUP BY x.vec_id, c.c) GROUP BY vec_id)"""
    move = """sums{r} AS (
  SELECT m.c AS c, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS about, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM near{r} JOIN x USING (vec_id) GROUP BY m.c, i),
cent{next} AS MATERIALIZED (
  SELECT c.c, c.i, CASE WHEN s.n IS NULL THEN c.x WHEN s.about * s.n > s.s THEN s.about - 1
         WHEN (s.about + 1) * s.n <= s.s THEN s.about + 1 ELSE s.about END AS x
  FROM cent{r} c LEFT JOIN sums{r} s ON c.c = s.c AND c.i = s.i)"""
    steps = [f"{near.format(r=r)},\n{move.format(r=r, next=r + 1)}" for r in range(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64),
x AS MATERIALIZED (
  SELECT vec_id, i, CAST(floor(64 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM kept, range(64) AS t(i)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM kept ORDER BY c LIMIT {k}),
cent0 AS MATERIALIZED (SELECT f.c, x.i, x.x FROM first f JOIN x USING (vec_id)),
{", ".join(steps)},
{near.format(r=rounds)},
a AS (SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance FROM near{rounds}),
t AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a GROUP BY cluster),
h AS (SELECT c AS cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM cent{rounds} GROUP BY c)
SELECT a.vec_id, a.cluster, a.distance, t.cluster_inertia,
       CAST((SELECT sum(distance) FROM a) AS BIGINT) AS inertia, h.centroid_sha256
FROM a JOIN t USING (cluster) JOIN h USING (cluster)
"""


ORACLE_SQL = {
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid
  FROM d GROUP BY source),
w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((sid - 1) % 3 + 1)::INT] AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / weight AS fills_at, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM w),
u AS (
  SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS unit
  FROM r WINDOW before AS (ORDER BY fills_at, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT fills_at, sid, unit FROM u WHERE cap > unit * weight ORDER BY fills_at, sid LIMIT 1),
t AS (
  SELECT u.source, u.sid, u.source_size,
         CASE WHEN o.sid IS NULL OR (u.fills_at, u.sid) < (o.fills_at, o.sid) THEN u.cap ELSE o.unit * u.weight END AS target
  FROM u LEFT JOIN o ON true),
q AS (
  SELECT d.doc_id, d.size, t.sid, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY t.sid ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT doc_id, size, sid, ((e - 1) * source_size + upto) / target AS finish
  FROM q, (VALUES (1), (2), (3)) AS epochs(e) WHERE size > 0 AND target > 0),
f AS (SELECT *, sum(size) OVER (ORDER BY finish, sid ROWS UNBOUNDED PRECEDING) AS spent FROM c),
k AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM f
  WHERE spent <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0) AS taken FROM q LEFT JOIN k USING (doc_id)
""",
    "op4_line_dedup": r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, lines, unnest(range(len(lines))) AS pos FROM l),
w AS (
  SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS part
  FROM p WHERE pos + 3 <= len(lines)),
later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY part ORDER BY doc_id, pos) AS n
    FROM w WHERE regexp_matches(part, '[^\x20\x09-\x0D]')) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later),
kept AS (
  SELECT p.doc_id, string_agg(p.lines[p.pos + 1], chr(10) ORDER BY p.pos) AS text
  FROM p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.pos = c.pos WHERE c.pos IS NULL GROUP BY p.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM covered GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op13_centroids": _centroid_sql(),
}
