"""Packing, word-piece counts, SentencePiece: against the libraries and plain code."""

import json
import random
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barlake.llm import packing, pieces, queries, token_counts

SF = "/root/testdata/sf0.001"
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
RNG = random.Random(3)
ODD = ["", "   ", "a b", "it's 'sword' ('tis) don't. (x) \"Yes\"!", "Σίσυφος ΟΔΟΣ", "a\x1cb\x85c", "<|endoftext|> hi",
       "é ́x İ K ſ", "日本語 123 ４５", "x" * 3000, "A.B,C... ...", "\t\n\x0b\x0cq ", "ǅ ß ẞ", "a_b __ c9d", "▁x▁▁y", "a\0b",
       "<s> <0x41> <unk>", *[" " * k + "the" for k in range(1, 40)], *[" " * k for k in range(1, 40)],
       *["".join(RNG.choice("aB' .,!?\"()é ́　\n19_-世🙂ing") for _ in range(50)) for _ in range(300)]]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def test_word_encoder_equals_the_library(library, texts):
    encoder = packing.WordEncoder(open(WORDS, encoding="utf-8").read())
    some = [*ODD, *texts.values()]
    for t, got in zip(some, encoder.encode([t.encode() for t in some])):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_word_encoder_with_little_memory(library, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    encoder = packing.WordEncoder(open(WORDS, encoding="utf-8").read())
    for t in ODD[:8]:
        assert np.frombuffer(encoder.encode([t.encode()])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_every_vocabulary_entry_merges_to_itself():
    """By the file's own list of pairs: the reason that ranks give the same ids."""
    model = json.loads(open(WORDS, encoding="utf-8").read())["model"]
    rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
    assert [model["vocab"]["".join(p)] for p in rank] == sorted(model["vocab"]["".join(p)] for p in rank)
    for entry in model["vocab"]:
        if entry.startswith("<|"):
            continue
        ends = entry.endswith("</w>")
        parts = list(entry.removesuffix("</w>"))
        parts[-1] += "</w>" if ends else ""
        while len(parts) > 1:
            best, k = min((rank.get(p, 1e9), k) for k, p in enumerate(zip(parts, parts[1:])))
            if best == 1e9:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [entry]


def test_packing_holds_each_id_once(spark, library, texts):
    rows = queries.op9_packing(spark, SF).collect()
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == ids.keys()
    for key, spans in [*by_doc.items(), *by_sequence.items()]:
        spans.sort()
        assert [s for s, _ in spans] == [0, *accumulate(n for _, n in spans)][:-1]
    assert all(sum(n for _, n in by_doc[i]) == len(own) for i, own in ids.items())
    sizes = [sum(n for _, n in s) for s in by_sequence.values()]
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert max(sizes) <= 2048 and padded / (padded + sum(sizes)) < 0.03


def test_differencing_is_near_equal_and_rises():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 513) for _ in range(800)]
    parts = packing.difference(sizes, 100)
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert sorted(i for p in parts for i in p) == list(range(800)) and max(sums) - min(sums) < 40
    assert packing.difference([], 3) == [] and packing.difference([5], 3) == [[0]]
    assert len(packing.windows([2048, 2048, 1])) == 3
    assert len(packing.windows([1100, 1100, 1100, 700])) == 3


def greedy(text, library, vocab):
    words = count = 0
    for part, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text)):
        words, i = words + 1, 0
        while i < len(part):
            i = next(j for j in range(len(part), i, -1) if part[i:j] + ("</w>" if j == len(part) else "") in vocab)
            count += 1
    return words, count


def test_token_counts_equal_greedy_matching(spark, library, texts):
    vocab = set(library.get_vocab())
    counter = token_counts.word_pieces(open(WORDS, encoding="utf-8").read())
    for t in ODD:
        assert counter.counts(t.encode()) == greedy(t, library, vocab)
    for r in queries.op10_token_counts(spark, SF).collect():
        assert (r["n_words"], r["n_tokens"]) == greedy(texts[r["doc_id"]], library, vocab)


def test_automaton_pops_several_pieces():
    pieces_ = ["a", "abcdx", "b", "c", "cdy", "dz"]
    found = token_counts.Automaton([p.encode() for p in pieces_])
    assert found.count(b"abcdz") == 4  # a b c dz
    assert found.count(b"abcdy") == 3  # a b cdy
    assert found.count(b"") == 0 and found.count(b"aq") == 1


def test_pieces_equal_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = pieces.piece_model(open(PIECES, "rb").read())
    vocabulary = [p.replace("▁", " ") for p in model.text[259:]]
    rng = random.Random(4)
    made = ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    made += ["".join(rng.choice("aeinrst") for _ in range(40)) for _ in range(500)]
    some = [*ODD, *made, *texts.values()]
    for t, ids, want in zip(some, pieces.encode_texts(some, model), library.encode(some)):
        got = np.frombuffer(ids, "<i4").tolist()
        assert got == want
        assert pieces.decode_ids(got, model) == library.decode(want)
    assert pieces.decode_ids([0, 1, 3 + 0xFF, 400], model) == library.decode([0, 1, 3 + 0xFF, 400])


def test_pieces_round_trip(spark):
    rows = queries.op5_sentencepiece(spark, SF).collect()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_suffix_array_ranges():
    rng = np.random.default_rng(2)
    codes = rng.integers(1, 4, 300).astype(np.int32)
    order = pieces.suffix_array(codes, 5)
    patterns = rng.integers(1, 4, (60, 5)).astype(np.int32)
    lengths = rng.integers(1, 6, 60)
    low, high = pieces.occurrences(codes, order, patterns, lengths)
    for p, n, a, b in zip(patterns, lengths, low, high):
        want = [i for i in range(300) if codes[i:i + n].tolist() == p[:n].tolist()]
        assert sorted(order[a:b].tolist()) == want


def test_suffix_array_takes_few_sorts(monkeypatch):
    """Sixteen letters of a small alphabet are two sorts, not one per doubling."""
    rng = np.random.default_rng(3)
    codes = rng.integers(97, 123, 5_000).astype(np.int32)
    sorts, sort = [], np.argsort
    monkeypatch.setattr(pieces.np, "argsort", lambda *a, **k: sorts.append(1) or sort(*a, **k))
    order = pieces.suffix_array(codes, 16)
    monkeypatch.undo()
    text = "".join(map(chr, codes))
    assert len(sorts) <= 2 and sorted(order.tolist()) == list(range(5_000))
    assert [text[i:i + 16] for i in order] == sorted(text[i:i + 16] for i in range(5_000))


def test_borders_are_merged_in_order(monkeypatch):
    model = pieces.PieceModel(open(PIECES, "rb").read())
    rng = np.random.default_rng(5)
    asked = [(rng.choice(model.piece_ids, 300), rng.choice(model.piece_ids, 300)) for _ in range(4)]
    sorts, sort = [], np.argsort
    monkeypatch.setattr(pieces.np, "argsort", lambda *a, **k: sorts.append(1) or sort(*a, **k))
    got = [model.may_follow(a, b).tolist() for a, b in asked]
    again = [model.may_follow(a, b).tolist() for a, b in asked]
    monkeypatch.undo()
    assert not sorts and got == again and got == [model._borders(a, b).tolist() for a, b in asked]
    assert (np.diff(model.border_keys) > 0).all() and len(model.border_keys) == len(model.border_stays)
