"""One query per operator, over its whole table, with production parameters; oracles where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumload.llm import alignment, decontamination, hard_negatives, jaccard, licences, line_quality, mixing, neighbours, packing, pii, quality, sharding, warc
from cumload.llm.common import scratch, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.slots(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.rate(table(spark, sf_dir, "documents"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).drop("row_key")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), scratch(spark, "warc")
    warc.write_archives(pages, warc.resolve(pages), path)
    return warc.revisits_resolved(warc.read_archives(spark, path))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out()))
    return quality.score(docs, model).withColumn("held_out", quality.held_out())


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), relabel=(7, 10))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_neighbours, op3_sharding, op4_packing, op5_line_quality, op6_jaccard, op7_warc, op8_quality, op9_licences, op10_pii, op11_decontamination, op12_alignment, op13_hard_negatives)}


#: Base32 of a SHA-1 in hex: five hex digits are four base32 digits.
_BASE32 = "ARRAY_TO_STRING(LIST_TRANSFORM(RANGE(32), lambda i: SUBSTR('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(FLOOR(CAST('0x' || SUBSTR(digest, 1 + 5 * (i // 4), 5) AS INTEGER) / POW(32, 3 - i % 4)) AS INTEGER) % 32, 1)), '')"
_OP7 = f"""WITH heads AS (SELECT page_id, OCTET_LENGTH(ENCODE(COALESCE(html, ''))) AS payload_bytes, SHA1(COALESCE(html, '')) AS digest FROM pages)
 SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM (SELECT *, MIN(page_id) OVER (PARTITION BY digest) AS first FROM heads)"""


_WORDS = "REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP11 = f"""WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
 pattern AS (SELECT DISTINCT item_id, UNNEST(LIST_TRANSFORM(RANGE(1, GREATEST(LEN(w) - 9, 1) + 1), lambda i: ARRAY_TO_STRING(w[i:i + 9], ' '))) AS p, LEAST(LEN(w), 10) AS n FROM item WHERE LEN(w) > 0),
 doc AS (SELECT doc_id, COALESCE({_WORDS}, []) AS w FROM documents),
 place AS (SELECT doc_id, n, UNNEST(RANGE(1, LEN(w) - n + 2)) AS i, UNNEST(LIST_TRANSFORM(RANGE(1, LEN(w) - n + 2), lambda i: ARRAY_TO_STRING(w[i:i + n - 1], ' '))) AS p FROM doc, (SELECT DISTINCT n FROM pattern)),
 hit AS (SELECT doc_id, place.n, i, item_id FROM place JOIN pattern ON place.p = pattern.p AND place.n = pattern.n),
 word AS (SELECT doc_id, COUNT(DISTINCT nth) AS n_hit FROM (SELECT doc_id, UNNEST(RANGE(i, i + n)) AS nth FROM hit) GROUP BY doc_id),
 of_doc AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n_items, STRING_AGG(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id)
 SELECT doc_id, CAST(LEN(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, SHA256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN of_doc USING (doc_id)"""
_OP13 = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(LIST_INNER_PRODUCT(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
 SELECT anchor_id, positive_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY ROW_NUMBER() OVER w <= 10"""


def oracle_sql() -> dict[str, str]:
    """op7, op11 and op13 in SQL; codes, draws, permutations, models, tokens and sampled paths are held against brute force in the tests."""
    return {"op7_warc": _OP7, "op11_decontamination": _OP11, "op13_hard_negatives": _OP13}
