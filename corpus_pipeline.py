"""Corpus preparation: quality, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next stage's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import packing, quality, secrets, simhash
from barlake.session import configure, scratch_path


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier, trained on the labels of
    ``sf_dir``, scores 0.3 or higher."""
    return quality.keep_good(docs, quality.model_for(spark, sf_dir, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest doc_id, of each SimHash component."""
    return simhash.keep_first(docs, width=3, budget=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked (n_chars follows)."""
    size = "n_chars" if "n_chars" in docs.columns else None
    return secrets.redact(docs, secrets.train(docs), size_col=size)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def _configured(stage):
    """The stage under the package's session settings."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)
    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


STAGES = [(name, _configured(stage)) for name, stage in (
    ("quality", keep_good_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
)]

#: A trained classifier and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
