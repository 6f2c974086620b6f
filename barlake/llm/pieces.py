"""SentencePiece encoding and decoding (BPE models): suffix-array matching.

The words of a batch that a worker has not met are concatenated and indexed by a
suffix array. Every piece is binary-searched for its range of occurrences; each
occurrence is an edge from its start to its end. Edges are sorted by position and
relaxed from left to right: the last piece of the encoding of every prefix is the
one that may follow the last piece of the encoding before it. Two pieces may
stand side by side if no merge across their border comes before the merges that
close the border, which their merge trees tell.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import map_texts, whole_texts

SPACE = "▁"
#: Distinct words whose ids a worker remembers; beyond it the memory starts anew.
KNOWN_WORDS = 300_000
#: Pairs of pieces whose border it remembers.
KNOWN_BORDERS = 1_000_000
#: New words indexed at once, in characters.
INDEX_CHARS = 500_000
_START, _OTHER, _NONE = -1, -2, -3


class PieceModel:
    """Pieces, ranks and merge trees of a SentencePiece BPE model file."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(data)
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model must leave characters and white space as they are")
        self.prefix = spec.add_dummy_prefix
        self.text: list[str] = [p.piece for p in proto.pieces]
        self.kind: list[int] = [p.type for p in proto.pieces]
        normal = [i for i, k in enumerate(self.kind) if k == 1]
        self.id = {self.text[i]: i for i in normal}
        self.byte_id = {int(self.text[i][1:-1], 16): i for i, k in enumerate(self.kind) if k == 6}
        blank_runs = {i for i in normal if set(self.text[i]) == {SPACE} and len(self.text[i]) > 1}
        if any(SPACE in self.text[i].lstrip(SPACE) or (self.text[i].startswith(SPACE * 2) and i not in blank_runs)
               for i in normal):
            raise ValueError("pieces may hold one word's start only")
        self.rank = {self.text[i]: -proto.pieces[i].score for i in normal if len(self.text[i]) > 1 and i not in blank_runs}
        self.blank_sizes = {len(self.text[i]) for i in blank_runs}
        self.split: dict[int, tuple[int, int]] = {}
        self.edge_pieces: list[int] = []
        for i in normal:
            if i in blank_runs:
                continue
            parts, last = self._merge(list(self.text[i]))
            if len(parts) == 1:  # else no text is encoded with this piece
                self.edge_pieces.append(i)
                if last is not None:
                    self.split[i] = (self.id[last[0]], self.id[last[1]])
        self.time = {i: self.rank.get(self.text[i], -1.0) for i in normal}
        late = {i for i, (a, b) in self.split.items() if max(self.time[a], self.time[b]) >= self.time[i]}
        self.right, self.left = {}, {}
        self.plain = set()  # pieces whose merge trees are made in the order of rank
        for i in self.edge_pieces:
            self.right[i], self.left[i] = self._spine(i, 1), self._spine(i, 0)
            if not late.intersection(self.right[i] + self.left[i]):
                self.plain.add(i)
        joins = {a * len(self.text) + b: self.rank[t] for t in self.rank for k in range(1, len(t))
                 if (a := self.id.get(t[:k])) is not None and (b := self.id.get(t[k:])) is not None}
        self.join_keys = np.array(sorted(joins), dtype=np.int64)
        self.join_ranks = np.array([joins[k] for k in self.join_keys.tolist()])
        deep = max(len(v) for d in (self.right, self.left) for v in d.values())
        #: Spines and the ranks at which their parts end, padded: a part that no merge ends has rank inf.
        self.spines = {side: (np.zeros((len(self.text), deep), dtype=np.int32), np.full((len(self.text), deep), np.inf))
                       for side in ("right", "left")}
        for side, spine in (("right", self.right), ("left", self.left)):
            parts, ends = self.spines[side]
            for i, own in spine.items():
                parts[i, :len(own)] = own
                ends[i, :len(own) - 1] = [self.time[p] for p in own[1:]]
        self.is_plain = np.zeros(len(self.text), dtype=bool)
        self.is_plain[list(self.plain)] = True
        self.border_keys = np.zeros(0, dtype=np.int64)
        self.border_stays = np.zeros(0, dtype=bool)
        lengths = np.array([len(self.text[i]) for i in self.edge_pieces])
        self.lengths = lengths
        self.codes = np.zeros((len(lengths), int(lengths.max(initial=1))), dtype=np.int32)
        for row, i in enumerate(self.edge_pieces):
            self.codes[row, :lengths[row]] = [ord(c) for c in self.text[i]]
        self.piece_ids = np.array(self.edge_pieces)
        #: Ids (little-endian 32-bit) of words met, with and without a word start.
        self.started: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.utf8 = [bytes([int(t[1:-1], 16)]) if k == 6 else b"" if k == 3 else " ⁇ ".encode() if k == 2
                     else t.replace(SPACE, " ").encode() for t, k in zip(self.text, self.kind, strict=True)]

    def _merge(self, parts: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Merge by rank, leftmost first; the parts that stay, and the last merge."""
        last = None
        while True:
            best = min(((self.rank.get(a + b, np.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))),
                       default=(np.inf, 0))
            if best[0] == np.inf:
                return parts, last
            k = best[1]
            last = (parts[k], parts[k + 1])
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def _spine(self, piece: int, side: int) -> list[int]:
        """The piece's outermost parts on one side, from single character to itself."""
        out = [piece]
        while out[-1] in self.split:
            out.append(self.split[out[-1]][side])
        return out[::-1]

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the text of pieces ``a`` and ``b`` together is encoded as these two."""
        keys = a.astype(np.int64) * len(self.text) + b
        asked, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.border_keys, asked)
        known = np.zeros(len(asked), dtype=bool)
        inside = at < len(self.border_keys)
        known[inside] = self.border_keys[at[inside]] == asked[inside]
        out = np.zeros(len(asked), dtype=bool)
        out[known] = self.border_stays[at[known]]
        new = asked[~known]
        if len(new):
            out[~known] = self._borders(new // len(self.text), new % len(self.text))
            if len(self.border_keys) + len(new) > KNOWN_BORDERS:
                self.border_keys, self.border_stays = asked, out
            else:
                self.border_keys = np.insert(self.border_keys, at[~known], new)
                self.border_stays = np.insert(self.border_stays, at[~known], out[~known])
        return out[back]

    def _borders(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Walk both merge trees along the border, always past the part that ends
        first: a merge across that comes before either part ends takes the border."""
        out = np.ones(len(a), dtype=bool)
        odd = np.flatnonzero(~(self.is_plain[a] & self.is_plain[b]))
        for k in odd.tolist():
            pair = [self.text[a[k]], self.text[b[k]]]
            out[k] = self._merge(list("".join(pair)))[0] == pair
        (right, right_ends), (left, left_ends) = self.spines["right"], self.spines["left"]
        rows = np.flatnonzero(self.is_plain[a] & self.is_plain[b])
        i, j = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        while len(rows):
            ends_x, ends_y = right_ends[a[rows], i], left_ends[b[rows], j]
            key = right[a[rows], i].astype(np.int64) * len(self.text) + left[b[rows], j]
            at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
            across = np.where(self.join_keys[at] == key, self.join_ranks[at], np.inf)
            # On equal ranks the merge further left comes first.
            taken = (across < ends_x) & ((across < ends_y) | ((across == ends_y) & (ends_y < np.inf)))
            out[rows[taken]] = False
            go = ~taken & ~((ends_x == np.inf) & (ends_y == np.inf))
            step = ends_x <= ends_y
            i, j, rows = (i + step)[go], (j + ~step)[go], rows[go]
        return out

    @lru_cache(maxsize=10_000)  # noqa: B019
    def blanks(self, n: int) -> bytes:
        """Ids of ``n`` word starts in a row: pairs merge leftmost first (all such
        pieces have one rank, below all others)."""
        size, after, before = [1] * n, list(range(1, n)) + [-1], list(range(-1, n - 1))
        heap = [(k, 1, 1) for k in range(n - 1)]
        while heap:
            k, a, b = heapq.heappop(heap)
            right = after[k]
            if size[k] != a or right < 0 or size[right] != b or a + b not in self.blank_sizes:
                continue
            size[k], size[right] = a + b, 0
            after[k] = after[right]
            if after[right] >= 0:
                before[after[right]] = k
                heapq.heappush(heap, (k, a + b, size[after[right]]))
            if before[k] >= 0:
                heapq.heappush(heap, (before[k], size[before[k]], a + b))
        return np.array([self.id[SPACE * s] for s in size if s], dtype="<i4").tobytes()


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of their first ``depth`` characters: each round sorts
    by as many ranks side by side as one integer holds."""
    present = np.zeros(int(codes.max(initial=0)) + 1, dtype=bool)
    present[codes] = True
    rank = np.cumsum(present)[codes]
    done = 1
    while True:
        base = int(rank.max(initial=0)) + 1  # 0 stands for what lies after the end
        key, joined = rank.copy(), 1
        while joined * done < depth and base ** (joined + 1) < 2 ** 63:
            key *= base
            key[:-joined * done] += rank[joined * done:]
            joined += 1
        order = np.argsort(key)
        done *= joined
        if done >= depth or joined == 1:
            return order
        ranked = key[order]
        rank[order] = np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]])


def occurrences(codes: np.ndarray, order: np.ndarray, patterns: np.ndarray,
                lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range [low, high) of ``order`` whose positions start with each pattern: one
    binary search per pattern and character, inside the range so far."""
    padded = np.concatenate([codes, np.full(patterns.shape[1] + 1, -1, dtype=codes.dtype)])
    low = np.zeros(len(patterns), dtype=np.int64)
    high = np.full(len(patterns), len(order), dtype=np.int64)
    for d in range(patterns.shape[1]):
        open_ = np.flatnonzero((lengths > d) & (high > low))
        if not len(open_):
            break
        want = patterns[open_, d]
        ends = []
        for upper in (False, True):
            a, b = low[open_].copy(), high[open_].copy()
            while True:
                active = np.flatnonzero(a < b)
                if not len(active):
                    break
                mid = (a[active] + b[active]) // 2
                seen = padded[order[mid] + d]
                goes = seen <= want[active] if upper else seen < want[active]
                a[active] = np.where(goes, mid + 1, a[active])
                b[active] = np.where(goes, b[active], mid)
            ends.append(a)
        low[open_], high[open_] = ends
    return low, np.maximum(low, high)


def encode_words(words: list[str], model: PieceModel) -> list[bytes]:
    """Ids of each word (no word start inside), all indexed together."""
    text = "\0".join(words) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<i4").astype(np.int32)
    sizes = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inside = np.ones(len(codes), dtype=bool)
    inside[starts + sizes] = False  # separators; a word's own NUL is a character
    order = suffix_array(codes, model.codes.shape[1])
    low, high = occurrences(codes, order, model.codes, model.lengths)
    hit = np.flatnonzero(high > low)
    counts = high[hit] - low[hit]
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = order[np.repeat(low[hit], counts) + within]
    length = np.repeat(model.lengths[hit], counts)
    piece = np.repeat(model.piece_ids[hit], counts)
    keep = inside[at] & inside[at + length - 1]
    at, length, piece = at[keep], length[keep], piece[keep]
    own = np.zeros(len(codes), dtype=bool)
    own[at[length == 1]] = True
    other = np.flatnonzero(inside & ~own)  # characters without a piece stand alone
    at = np.concatenate([at, other])
    length = np.concatenate([length, np.ones(len(other), dtype=np.int64)])
    piece = np.concatenate([piece, np.full(len(other), _OTHER)])
    # Edges by their end in the word: those of one end, in all words, are relaxed together.
    offset = np.arange(len(codes)) - np.repeat(starts, sizes + 1)
    end = at + length
    reach = offset[end - 1] + 1
    by_end = np.argsort(reach, kind="stable")
    at, end, piece, reach = at[by_end], end[by_end], piece[by_end], reach[by_end]
    last = np.full(len(codes) + 1, _NONE)
    back = np.zeros(len(codes) + 1, dtype=np.int64)
    last[starts] = _START
    cuts = np.concatenate([np.flatnonzero(np.r_[True, reach[1:] != reach[:-1]]), [len(reach)]]) if len(reach) else [0]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        before, now = last[at[lo:hi]], piece[lo:hi]
        good = (before == _START) | (before == _OTHER) | ((now == _OTHER) & (before != _NONE))
        ask = np.flatnonzero(~good & (before >= 0))
        good[ask] = model.may_follow(before[ask], now[ask])
        last[end[lo:hi][good]] = now[good]
        back[end[lo:hi][good]] = at[lo:hi][good]
    # Back from the end of every word, one piece at a time.
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    row, place = np.flatnonzero(sizes > 0), (starts + sizes)[sizes > 0]
    while len(row):
        taken.append((row, place))
        place = back[place]
        more = place > starts[row]
        row, place = row[more], place[more]
    if not taken:
        return [b""] * len(words)
    rows = np.concatenate([r for r, _ in taken])
    places = np.concatenate([p for _, p in taken])
    order = np.lexsort((places, rows))
    rows, ids = rows[order], last[places[order]].astype("<i4")
    ends = np.cumsum(np.bincount(rows, minlength=len(words)))
    flat = ids.tobytes()
    out = [flat[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    for r in np.unique(rows[ids == _OTHER]).tolist():  # their UTF-8 bytes instead
        found, spot = [], int(starts[r])
        for i in np.frombuffer(out[r], dtype="<i4").tolist():
            size = 1 if i == _OTHER else len(model.text[i])
            found += [model.byte_id[b] for b in text[spot].encode()] if i == _OTHER else [i]
            spot += size
        out[r] = np.array(found, dtype="<i4").tobytes()
    return out


def _learn(wanted: set[str], known: dict[str, bytes], head: str, model: PieceModel) -> None:
    """Add the ids of the new among ``wanted`` words, each after ``head``, a block of
    them at a time; where the memory is full it starts anew with all of them."""
    words = wanted.difference(known)
    if len(known) + len(words) > KNOWN_WORDS:
        known.clear()
        words = wanted
    block: list[str] = []
    held = 0
    for w in words:
        block.append(w)
        held += len(w) + 2
        if held >= INDEX_CHARS:
            known.update(zip(block, encode_words([head + x for x in block], model), strict=True))
            block, held = [], 0
    if block:
        known.update(zip(block, encode_words([head + x for x in block], model), strict=True))


def _with_blanks(words: list[str], model: PieceModel) -> bytes:
    """Ids of words that each follow a word start; an empty word is a start alone,
    which merges with the starts beside it."""
    out, waiting, blank = [], 0, model.id[SPACE].to_bytes(4, "little")
    for w in words:
        waiting += 1
        if w:
            ids = model.started[w]
            if waiting > 1:
                alone = ids[:4] == blank
                out.append(model.blanks(waiting if alone else waiting - 1))
                ids = ids[4:] if alone else ids
            out.append(ids)
            waiting = 0
    if waiting:
        out.append(model.blanks(waiting))
    return b"".join(out)


def encode_texts(texts: list[str], model: PieceModel) -> list[bytes]:
    """Ids (little-endian 32-bit) of each text, as the model's own library gives
    them. A text is cut at blanks, where words start, and at line breaks, which no
    piece holds."""
    split = [[line.split(" ") for line in t.replace(SPACE, " ").split("\n")] if t else [] for t in texts]
    started: set[str] = set()
    bare: set[str] = set()
    for lines in split:
        for n, words in enumerate(lines):
            if n or not model.prefix:
                bare.add(words[0])
                started.update(words[1:])
            else:
                started.update(words)
    for wanted, known, head in ((started, model.started, SPACE), (bare, model.bare, "")):
        wanted.discard("")
        _learn(wanted, known, head, model)
    get, first = model.started.__getitem__, model.bare
    line_break = model.byte_id[10].to_bytes(4, "little")
    out = []
    for lines in split:
        done = []
        for n, words in enumerate(lines):
            head = b""
            if n or not model.prefix:
                head = first[words[0]] if words[0] else b""
                words = words[1:]
            done.append(head + (_with_blanks(words, model) if "" in words else b"".join(map(get, words))))
        out.append(line_break.join(done))
    return out


def decode_ids(ids: list[int], model: PieceModel) -> str:
    """Text of ids: byte pieces joined (invalid UTF-8 replaced), control pieces
    empty, the added word start dropped."""
    data = b"".join(map(model.utf8.__getitem__, ids))
    if model.prefix:  # the first piece that stands for text may hold the added start
        first = next((i for i in ids if model.kind[i] != 3), None)
        if first is not None and model.text[first].startswith(SPACE):
            data = data[1:]
    return data.decode(errors="replace")


_MODELS: dict[int, PieceModel] = {}


def piece_model(data: bytes) -> PieceModel:
    """One model per worker and file."""
    key = zlib.crc32(data)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(data)
    return _MODELS[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, ids array<int>, round_trip boolean): one row per input row;
    ``round_trip`` says whether the ids decode to the very text.

    ``model_file`` is the path, on the driver, of a SentencePiece BPE model with
    byte fallback; its content goes to the tasks. A null text is empty and has no
    ids. Repeated rows stay, a null doc_id stays null, extra columns are not
    carried, an empty table gives none. Whole texts, however long.
    """
    data = _read(model_file)

    def make() -> Callable:
        model = piece_model(data)

        def run(cols: dict) -> dict:
            ids = encode_texts(cols["text"], model)
            ends = np.cumsum([0] + [len(i) // 4 for i in ids], dtype=np.int32)
            values = np.frombuffer(b"".join(ids), dtype="<i4")
            same = [decode_ids(np.frombuffer(i, dtype="<i4").tolist(), model) == t
                    for i, t in zip(ids, cols["text"], strict=True)]
            return {"doc_id": cols["doc_id"], "round_trip": same,
                    "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values))}
        return run

    return map_texts(whole_texts(docs, id_col, text_col), make, "doc_id long, ids array<int>, round_trip boolean")


def decode_column(model_file: str) -> Callable[[Column], Column]:
    """Column function: text of an array of ids. Null ids are none (an empty text);
    null entries are skipped."""
    data = _read(model_file)

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        model = piece_model(data)
        return pd.Series([decode_ids(i.tolist(), model) for i in ids], dtype=object)

    def of(ids: Column) -> Column:
        known = F.filter(ids.cast("array<int>"), lambda i: i.isNotNull())
        return text_of(F.coalesce(known, F.array().cast("array<int>")))
    return of
