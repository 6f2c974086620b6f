"""Token counts: greedy longest-match word pieces by a linear automaton.

The vocabulary is a trie. Every node has a failure link (the node of what is left
once the longest pieces are popped off its string) and the number of pieces
popped on the way, so one pass over a word counts its pieces; no piece is built.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from barlake.llm.common import byte_letters, map_texts, whole_texts

#: Distinct words whose counts a worker remembers; beyond it the memory starts anew.
KNOWN_WORDS = 500_000
_EDGE_PUNCTUATION = b'.,!?;:()"'


class Automaton:
    """Trie of pieces (sequences of symbols) with failure links and popped counts."""

    def __init__(self, pieces: Iterable[Sequence[int]]):
        self.child: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                if symbol not in self.child[node]:
                    self.child[node][symbol] = len(self.child)
                    self.child.append({})
                    ends.append(False)
                node = self.child[node][symbol]
            ends[node] = True
        self.fail = [-1] * len(self.child)
        self.popped = [0] * len(self.child)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for symbol, kid in self.child[node].items():
                queue.append(kid)
                if ends[kid]:
                    self.fail[kid], self.popped[kid] = 0, 1
                    continue
                at, count = self.fail[node], self.popped[node]
                while at >= 0 and symbol not in self.child[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                self.fail[kid] = self.child[at][symbol] if at >= 0 else -1
                self.popped[kid] = count

    def count(self, word: Sequence[int]) -> int:
        """Pieces of ``word`` by greedy longest match; 1 if it cannot be parted
        (the whole word is then one unknown token). 0 for an empty word."""
        node, count, child, fail, popped = 0, 0, self.child, self.fail, self.popped
        for symbol in word:
            while symbol not in child[node]:
                count += popped[node]
                node = fail[node]
                if node < 0 or (node == 0 and symbol not in child[0]):
                    return 1
            node = child[node][symbol]
        while node > 0:
            count += popped[node]
            node = fail[node]
        return 1 if node < 0 else count


class WordPieces:
    """Words of a `tokenizers` file with a word-end suffix, and their piece counts.

    A word's last byte is a symbol of its own (256 higher), as pieces with the
    suffix can only end a word. Normalising and splitting are the file's.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        model = json.loads(spec)["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if not suffix:
            raise ValueError("the tokenizer file has no word-end suffix")
        special = {t["content"] for t in json.loads(spec).get("added_tokens", [])}
        self.byte_of = byte_letters()
        pieces = []
        for piece in model["vocab"]:
            if piece in special or piece == suffix:
                continue
            ends = piece.endswith(suffix)
            letters = [self.byte_of[c] for c in piece.removesuffix(suffix)]
            if ends:
                letters[-1] += 256
            pieces.append(letters)
        self.automaton = Automaton(pieces)
        self.known: dict[bytes, tuple[int, int]] = {}

    def _parts(self, word: bytes) -> list[bytes]:
        core = word.strip(_EDGE_PUNCTUATION)
        if core and core.isalpha():  # ASCII letters; the punctuation splits off
            head = word.index(core)
            return [x for x in (word[:head], core, word[head + len(core):]) if x]
        text = self.tokenizer.normalizer.normalize_str(word.decode())
        return [bytes(self.byte_of[c] for c in part) for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _count(self, word: bytes) -> tuple[int, int]:
        parts = self._parts(word)
        return len(parts), sum(self.automaton.count([*p[:-1], p[-1] + 256]) for p in parts)

    def counts(self, text: bytes) -> tuple[int, int]:
        """(words, pieces) of a UTF-8 text. ASCII white space parts words for sure,
        so what stands between is looked up, or parted and counted once."""
        words = pieces = 0
        known = self.known
        for w in text.lower().split():
            got = known.get(w)
            if got is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                got = known[w] = self._count(w)
            words += got[0]
            pieces += got[1]
        return words, pieces


_LOADED: dict[int, WordPieces] = {}


def word_pieces(spec: str) -> WordPieces:
    """One automaton per worker and tokenizer file."""
    key = zlib.crc32(spec.encode())
    if key not in _LOADED:
        _LOADED[key] = WordPieces(spec)
    return _LOADED[key]


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, n_words long, n_tokens long): one row per input row.

    ``tokenizer`` is the path, on the driver, of a `tokenizers` file with a
    word-end suffix; its content goes to the tasks. Null and empty texts count 0.
    Repeated rows stay, a null doc_id stays null, extra columns are not carried,
    an empty table gives none. Very long texts and words are counted whole.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()

    def make() -> Callable:
        pieces = word_pieces(spec)

        def run(cols: dict) -> dict:
            got = [pieces.counts(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_words": [w for w, _ in got], "n_tokens": [p for _, p in got]}
        return run

    return map_texts(whole_texts(docs, id_col, text_col), make, "doc_id long, n_words long, n_tokens long", binary=True)
