"""The corpus pipeline, stage by stage, against plain code."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import quality, secrets

from .test_simhash import plain_fingerprint, plain_roots

SF = "/root/testdata/sf0.001"


def test_stages(spark, docs, texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF).cache()
    model = quality.model_for(spark, SF, docs)
    ids = sorted(texts)
    score = dict(zip(ids, quality.scores([texts[i].encode() for i in ids], model)))
    assert sorted(r["doc_id"] for r in good.collect()) == [i for i in ids if score[i] >= 0.3]
    assert good.columns == docs.columns

    single = stages["near_duplicates"](spark, good, SF).cache()
    kept = [i for i in ids if score[i] >= 0.3]
    roots = plain_roots([plain_fingerprint(texts[i]) for i in kept], lambda a, b: (a ^ b).bit_count() <= 3)
    assert sorted(r["doc_id"] for r in single.collect()) == [i for i, r in zip(kept, roots) if kept[r] == i]
    assert single.columns == docs.columns

    clean = stages["secrets"](spark, single, SF).cache()
    assert clean.columns == docs.columns and clean.count() == single.count()
    assert clean.filter(F.length("text") != F.col("n_chars")).count() == 0
    found = secrets.scan(single, secrets.train(single)).filter(F.size("spans") > 0).select("doc_id").collect()
    hit = {r["doc_id"] for r in found}
    for r in clean.collect():
        assert (r["text"] != texts[r["doc_id"]]) == (r["doc_id"] in hit)
        assert not re.search(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", r["text"])

    packed = stages["packing"](spark, clean, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in clean.collect()}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_on_no_rows(spark, docs):
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name
