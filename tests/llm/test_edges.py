"""Every operator on nulls, empty and long texts, repeats, clashing columns, no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from barlake.llm import (embeddings, licenses, packing, pieces, pii, quality, secrets, simhash, spotsigs,
                         token_counts)

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MODEL = quality.Model(None, 0.7)

PER_ROW = {
    "spotsigs": spotsigs.compare_with_next,
    "spotsigs_sets": spotsigs.near_duplicates,
    "quality": lambda d: quality.classify(d, MODEL),
    "pii": lambda d: pii.scan(d, pii.train()),
    "pieces": lambda d: pieces.encode(d, PIECES),
    "licenses": licenses.scan,
    "secrets": lambda d: secrets.scan(d, secrets.train(d)),
    "simhash": simhash.near_duplicates,
    "token_counts": lambda d: token_counts.count_tokens(d, WORDS),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(odd, name):
    got = PER_ROW[name](odd).collect()
    assert len(got) == odd.count()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", [*PER_ROW, "packing"])
def test_empty_table(odd, name):
    run = PER_ROW.get(name, lambda d: packing.pack(d, WORDS))
    assert run(odd.limit(0)).collect() == []


def test_packing_odd_rows(odd, texts):
    got = packing.pack(odd, WORDS, with_ids=True).collect()
    assert sum(1 for r in got if r["start"] == 0) == odd.count()
    assert all(len(r["ids"]) == r["length"] for r in got)
    empty = [r for r in got if r["doc_id"] in (1, 2, 3, 8)]
    assert [(r["length"], r["ids"]) for r in empty] == [(1, [packing.END_ID])] * 4


def test_defined_values(odd):
    by = {}
    for r in simhash.near_duplicates(odd).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["fingerprint"] for i in (1, 2, 3, 8) for r in by[i]} == {"0" * 16}
    assert {r["component_id"] for i in (1, 2, 3, 8) for r in by[i]} == {1}
    assert [r["component_id"] for r in by[5]] == [5, 5]
    assert {r["component_id"] for r in by[None]} == {1, 5}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"], (r["text"] or "")[:7]) for r in kept.collect()) == [
        (1, ""), (4, "the wor"), (5, "the big"), (7, "é世🙂")]
    scored = quality.classify(odd, MODEL).filter("doc_id is null").collect()
    assert [r["held_out"] for r in scored] == [False, False]


def test_stages_keep_columns(odd):
    model = secrets.train(odd)
    clean = secrets.redact(odd.withColumn("n_chars", F.length("text")), model, size_col="n_chars")
    assert clean.columns == [*odd.columns, "n_chars"]
    assert clean.filter("doc_id = 1").first()["text"] is None
    assert quality.keep_good(odd, MODEL).columns == odd.columns
    masked = pii.redact(odd, pii.train())
    assert masked.columns == odd.columns and masked.filter("text is null").count() == 3


def test_embeddings_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (None, [1.0, 0.001]),
            (7, [1.0, None]), (8, []), (9, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (10, [-1.0, -0.0]), (11, [float("inf"), 0.0])]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id int, embedding array<double>, node int, n_links int")
    for block in (1024, 1):
        got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"])
               for r in embeddings.near_duplicates(df, block=block).collect()}
        alone = {(i, 0, i, True) for i in (3, 4, 5, 7, 8, 9, 10, 11)}
        assert got == alone | {(1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False)}
    assert embeddings.near_duplicates(df.limit(0)).collect() == []
