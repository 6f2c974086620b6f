import random
import re

import numpy as np
import xxhash

from barlake.llm import simhash
from barlake.llm.components import components, local_roots


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_roots(values, linked):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_classes_equal_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, hot=3).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    assert [got[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    roots = plain_roots(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    assert [got[i]["component_id"] for i in ids] == [ids[r] for r in roots]


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i) for i in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text.encode()) == whole


def near(rng, centre, bits):
    for _ in range(bits):
        centre ^= 1 << rng.randrange(64)
    return centre


def test_all_pairs_of_clustered_fingerprints(spark):
    """Clusters that share their top or low bits, so that buckets are hot, and the
    sign bit: the tries join what a comparison of all pairs joins."""
    rng = random.Random(3)
    fps = {near(rng, c, rng.randrange(5)) for c in (0, 2**64 - 1, 0xF0F0F0F0F0F0F0F0, 1 << 63) for _ in range(60)}
    fps |= {rng.getrandbits(64) for _ in range(50)} | {(0xABC << 52) | rng.getrandbits(14) for _ in range(80)}
    signed = sorted(f - 2**64 if f >= 2**63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = plain_roots(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    for hot in (2, 10**6):
        roots = {r["node"]: r["root"] for r in components(simhash.links(df, 3, hot)).collect()}
        assert [roots.get(f, f) for f in signed] == [signed[r] for r in want]


def test_trie_pairs_small_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 16)
    rng = np.random.default_rng(1)
    tails = np.unique(rng.integers(0, 1 << 12, 300))
    got = {(int(min(i, j)), int(max(i, j))) for a, b in simhash.trie_pairs(
        tails, np.array([0]), np.array([len(tails)]), 12, 2) for i, j in zip(a, b)}
    want = {(i, j) for j in range(len(tails)) for i in range(j) if int(tails[i] ^ tails[j]).bit_count() <= 2}
    assert got == want


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 400)]
    hub = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 3)]
    df = spark.createDataFrame(chain + hub, "a long, b long").repartition(7)
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, 401)} | {1000 + i: 1000 for i in range(1, 300)}
    assert components(df.limit(0)).collect() == []
    assert local_roots(4, np.array([3, 2]), np.array([2, 1])).tolist() == [0, 1, 1, 1]
