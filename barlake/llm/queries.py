"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (conversations, embeddings, licenses, linededup, negatives, packing, pieces, pii, quality,
                         secrets, simhash, spotsigs, token_counts)
from barlake.llm.common import documents


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked at a cosine of 0.9 and more, and their components."""
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and the next document."""
    return spotsigs.compare_with_next(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the byte-level convolutional network."""
    docs = documents(spark, sf_dir)
    return quality.classify(docs, quality.model_for(spark, sf_dir, docs))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, by pattern and by boosted trees."""
    found = pii.scan(documents(spark, sf_dir), pii.train())
    return found.select("doc_id", *[pii.count_of("base", k).alias(f"n_{k}") for k in pii.BASE_KINDS],
                        F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and whether they decode to its text."""
    import public_tokenizers
    encoded = pieces.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences stated in every document."""
    return licenses.scan(documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by Markov models."""
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(
        "doc_id", *[secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
        secrets.count_of(F.col("spans"), "random").alias("n_random"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of every document: 3-word shingles, 3 differing bits."""
    return simhash.near_duplicates(documents(spark, sf_dir), width=3, budget=3)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    import public_tokenizers
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    import public_tokenizers
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, for each of its positives."""
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a smaller doc_id holds already."""
    kept = linededup.scan(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired at least cost."""
    return conversations.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_spotsigs": op2_spotsigs,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_licenses": op6_licenses,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_negatives": op11_negatives,
    "op12_linededup": op12_linededup,
    "op13_conversations": op13_conversations,
}

ORACLE: dict[str, str] = {
    "op1_embeddings": """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
usable AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l USING (vec_id) LEFT JOIN counts c USING (vec_id)""",
    "op11_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s
  WHERE same AND vec_id <> anchor_id QUALIFY n <= 5),
f AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 10""",
    "op12_linededup": """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce("text", ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM docs),
keyed AS (
  SELECT r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT r, doc_id, i, line, coalesce(doc_id <> first, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r""",
}
