"""SpotSigs and embeddings against comparisons of all pairs."""

import hashlib

import numpy as np
import xxhash

from barlake.llm import embeddings, queries, spotsigs

from .test_simhash import plain_roots

SF = "/root/testdata/sf0.001"


def likeness(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_spotsigs_query(spark, texts):
    got = {r["doc_id"]: r for r in queries.op2_spotsigs(spark, SF).collect()}
    ids = sorted(texts)
    for i, following in zip(ids, [*ids[1:], ids[0]]):
        own, other, r = texts[i], texts[following], got[i]
        cut = len(own) // 4
        edited = own[:len(own) - cut] + other[:cut]
        a, b, c = (spotsigs.signatures(t.encode()) for t in (own, edited, other))
        assert (r["n_chars"], r["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.fingerprint(a), spotsigs.fingerprint(b))
        assert abs(r["near_edited"] - likeness(a, b)) < 1e-12 and abs(r["near_next"] - likeness(a, c)) < 1e-12
    assert len(got) == len(ids)


def test_next_document_of_ties_and_one_row(spark):
    rows = [(5, "b the cat"), (5, "a the cat"), (9, None)]
    got = spotsigs.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    edited = {r["n_chars"]: r["edited_sha256"] for r in got if r["doc_id"] == 9}
    assert edited == {0: hashlib.sha256(b"").hexdigest()}
    hashes = {r["edited_sha256"] for r in got if r["doc_id"] == 5}
    assert hashes == {hashlib.sha256(t).hexdigest() for t in (b"a the cb ", b"b the c")}
    one = spotsigs.compare_with_next(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_signatures():
    assert spotsigs.signatures(b"") == set()
    assert spotsigs.signatures(b"!!! ???") and spotsigs.signatures(b"The CAT") == spotsigs.signatures(b"the, cat!")
    assert spotsigs.fingerprint({255, 1}) == "00000001000000ff"


def test_a_lost_common_word_costs_one_signature():
    """No count of anchors is a border: the sets differ by that word's signature alone."""
    rng = np.random.default_rng(3)
    for n_content in (30, 400):
        content = ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(n_content)]
        for anchors in range(2, 13):
            words = list(content)
            for k in range(anchors):
                words.insert((k + 1) * len(words) // (anchors + 1), "the")
            whole = spotsigs.signatures(" ".join(words).encode())
            words.remove("the")
            less = spotsigs.signatures(" ".join(words).encode())
            assert less <= whole and len(whole) - len(less) == 1
            if n_content == 400:
                assert likeness(whole, less) > 0.95


def test_texts_without_anchors_are_told_apart():
    plain = [w for w in ("zebra", "quartz", "violin", "hammer", "pocket", "silver", "orange", "winter", "garden", "bridge",
                         "candle", "mirror") if xxhash.xxh32_intdigest(w.encode()) % spotsigs.EVERY]
    a, b = " ".join(plain), " ".join(plain[::-1])
    assert likeness(spotsigs.signatures(a.encode()), spotsigs.signatures(b.encode())) < 0.2
    assert not spotsigs.signatures(a.encode()) & spotsigs.signatures(("the " + a).encode())


def test_pruned_jaccard_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(500):
        a, b = (set(rng.integers(0, 30, rng.integers(0, 25)).tolist()) for _ in range(2))
        j = likeness(a, b)
        assert spotsigs.jaccard(a, b) == j
        for floor in (0.2, 0.5, 0.8, 1.0):
            assert spotsigs.jaccard(a, b, floor) == (j if j >= floor - 1e-12 else 0.0)


def test_spotsigs_classes(spark, docs, texts, monkeypatch):
    ids = sorted(texts)
    sets = [spotsigs.signatures(texts[i].encode()) for i in ids]
    for threshold, block in ((0.8, 512), (0.3, 2)):
        monkeypatch.setattr(spotsigs, "BLOCK", block)
        roots = plain_roots(sets, lambda a, b: likeness(a, b) >= threshold - 1e-12)  # noqa: B023
        got = {r["doc_id"]: r["class_id"] for r in spotsigs.near_duplicates(docs, threshold).collect()}
        assert [got[i] for i in ids] == [ids[r] for r in roots]


def test_embeddings_clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([c + rng.normal(size=(15, 16)) * s for c in centres for s in (0.05, 0.3)])
    x = np.concatenate([x, np.repeat(centres[:1], 40, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    roots = plain_roots(list(range(len(x))), lambda a, b: close[a, b])
    for block in (1024, 7):
        got = sorted(embeddings.near_duplicates(df, recall=0.99999, block=block).collect(), key=lambda r: r["vec_id"])
        assert [r["n_links"] for r in got] == (close.sum(axis=1) - 1).tolist()
        assert [r["component_id"] for r in got] == roots
        assert [r["kept"] for r in got] == [r["vec_id"] == r["component_id"] for r in got]


def test_layout_reaches_the_recall():
    for nodes in (0, 1, 10_000, 10**9):
        bits, tables = embeddings.layout(nodes, 0.9, 0.99)
        same = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.99


def test_embeddings_query(spark):
    got = {r["vec_id"]: r for r in queries.op1_embeddings(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in table], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert [got[r["vec_id"]]["n_links"] for r in table] == ((x @ x.T >= 0.9).sum(axis=1) - 1).tolist()
