"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (alignment, ann, fingerprint, licenses, linededup, lmscore, mixing, neardup, packing,
                          passages, runs, sharding, toxicity)
from tickloom.llm.text import table

TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return register


@query("op1_lm_score")
def op1_lm_score(spark, sf_dir):
    return lmscore.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_line_dedup", """
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
keyed AS (
  SELECT doc_id, r, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM lines),
stripped AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM keyed),
frequent AS (SELECT key FROM stripped WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT s.*, f.key IS NOT NULL AS gone FROM stripped s LEFT JOIN frequent f ON s.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id""")
def op2_line_dedup(spark, sf_dir):
    kept = linededup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                       F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


@query("op3_minhash_near_dedup", r"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT r, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM given),
weighed AS (SELECT r, s, count(*) AS c FROM shingles GROUP BY ALL),
sizes AS (SELECT r, sum(c) AS t FROM weighed GROUP BY r),
common AS (
  SELECT a.r AS ra, b.r AS rb, sum(least(a.c, b.c)) AS m
  FROM weighed a JOIN weighed b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT ra, rb FROM common JOIN sizes x ON x.r = ra JOIN sizes y ON y.r = rb WHERE 10 * m >= 8 * (x.t + y.t - m)),
ways AS (SELECT ra AS one, rb AS other FROM links UNION ALL SELECT rb, ra FROM links),
reached AS (
  SELECT r, r AS c FROM given
  UNION
  SELECT ways.other, reached.c FROM reached JOIN ways ON ways.one = reached.r),
classes AS (SELECT reached.r, min(given.doc_id) AS class_id FROM reached JOIN given ON given.r = reached.c GROUP BY reached.r)
SELECT doc_id, class_id FROM given JOIN classes USING (r)""")
def op3_minhash_near_dedup(spark, sf_dir):
    found = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id")


@query("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    found = toxicity.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              table(spark, sf_dir, "labels"))
    return found.select("doc_id", "p_poor", "p_toxic", F.col("_rejected").alias("toxic"))


@query("op6_packing")
def op6_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op7_mixing", """
WITH sized AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3 AS most,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::DOUBLE
             / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE) AS lev
  FROM weighed
  WINDOW before AS (ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(most::DOUBLE, max(lev) OVER () * weight::DOUBLE) AS target FROM levels),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS drawn
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated""")
def op7_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"),
                        (F.col("_size") * F.col("_copies")).alias("taken"))


@query("op8_fingerprint")
def op8_fingerprint(spark, sf_dir):
    return fingerprint.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op9_vantage_point_ann", """
WITH doubles AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
usable AS (
  SELECT vec_id, v, len(v) AS d FROM doubles
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
common AS (SELECT d FROM usable GROUP BY d ORDER BY count(*) DESC, d LIMIT 1),
rows_ AS (SELECT DISTINCT vec_id, v FROM usable WHERE d = (SELECT d FROM common)),
scored AS (
  SELECT q.vec_id AS query_id, q.v AS qv, r.vec_id,
         list_reduce(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]), lambda s, x: s + x) AS score
  FROM rows_ q JOIN rows_ r ON q.vec_id % 20 = 0 AND (q.vec_id <> r.vec_id OR q.v <> r.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS place, vec_id, score
  FROM scored)
SELECT query_id, place::INT AS rank, vec_id, score FROM ranked WHERE place <= 20""")
def op9_vantage_point_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = runs.periodic_runs(runs.with_loops(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.shorter") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: CRC-32 of UTF-8 bytes byte by byte, with the table made from the reversed polynomial.
CRC32_SQL = """
crc_table AS (
  SELECT list(v ORDER BY i) AS crc_of FROM (
    SELECT i, list_reduce([i::UBIGINT] || range(8)::UBIGINT[], lambda a, b:
             CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
    FROM range(256) AS bytes(i))),
hashed AS (
  SELECT documents.*, xor(list_reduce(
           [4294967295::UBIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                   lambda x: ('0x' || x)::UBIGINT),
           lambda a, b: xor(a >> 8, crc_of[(xor(a, b) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM documents, crc_table)"""


@query("op12_sharding", f"""
WITH {CRC32_SQL},
keyed AS (
  SELECT doc_id, source, text_crc32, coalesce(strlen(text), 0)::BIGINT + 16 AS size, text IS NULL AS no_text,
         md5('shard-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM hashed),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY key, no_text) - 1)::DOUBLE
              / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS share
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY share, source NULLS LAST, key, no_text) - 1 AS place, count(*) OVER () AS total
  FROM ranked),
cut AS (SELECT *, place * 40 // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard,
       (place - (shard * total + 39) // 40)::BIGINT AS slot, NULL::INT AS grown_shard
FROM cut""")
def op12_sharding(spark, sf_dir):
    placed = sharding.interleave(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return placed.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark, sf_dir):
    aligned = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECE_MODEL), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
