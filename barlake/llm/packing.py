"""Packing documents into fixed windows: Karmarkar-Karp multiway differencing.

Every task packs the rows of its own input partition, so there is no shuffle and
no group of unbounded size, and a lost task is redone from the same partition.
Whole windows are cut off a document first. The rest (less than a window) is cut
into pieces of at most ``PIECE_TOKENS`` and waits until ``BATCH_WINDOWS`` windows
are nearly filled. The waiting pieces are then parted by differencing: the two
partial partitions of largest imbalance are merged with opposing order, the
fullest slot of one with the emptiest of the other. If a window exceeds its
capacity, the window count rises and the batch is parted anew.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.llm.common import byte_letters, slices, whole_texts

WINDOW = 2048
PIECE_TOKENS = 512
BATCH_WINDOWS = 128
#: Tokens that a window of a full batch leaves free for the differences that remain.
SLACK_TOKENS = 16
END_ID = 1
#: Distinct words whose ids a worker remembers; beyond it the memory starts anew.
KNOWN_WORDS = 600_000

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")

_EDGE_PUNCTUATION = b'.,!?;:()"'
#: A byte that no UTF-8 text holds.
WORD_END = b"\xff"
#: Latin-1 letters: simple lower case, and what is then a word of them (these
#: stay as they are under the file's normalising).
_LOWER = {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def difference(sizes: list[int], slots: int) -> list[list[int]]:
    """Indices of ``sizes`` parted into ``slots`` lists of near-equal sums.

    A partial partition holds its non-empty slots in descending order; the slots
    it lacks are empty.
    """
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - slots)
        a_own, b_own = len(a) - shared, len(b) - shared
        sums = a[:a_own] + b[:b_own]
        items = a_items[:a_own] + b_items[:b_own]
        sums += [x + y for x, y in zip(a[a_own:], reversed(b[b_own:]), strict=True)]
        items += [x + y for x, y in zip(a_items[a_own:], reversed(b_items[b_own:]), strict=True)]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums = [sums[i] for i in order]
        spread = sums[0] - (sums[-1] if len(sums) == slots else 0)
        heapq.heappush(heap, (-spread, serial, sums, [items[i] for i in order]))
        serial += 1
    return heap[0][3] if heap else []


def windows(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Indices of ``sizes`` by window: the fewest windows, from the sum up, for
    which differencing keeps every window within its capacity."""
    slots = max(1, -(-sum(sizes) // window))
    while True:
        parts = difference(sizes, slots)
        if all(sum(sizes[i] for i in p) <= window for p in parts):
            return parts
        slots += 1


class WordEncoder:
    """Ids of whole texts by a `tokenizers` file whose words end at white space.

    Texts are cut at ASCII white space, which the file's own splitting drops and
    never matches across, so a text's ids are its words' ids in order. A worker
    remembers the ids of words it has met. The strings of special tokens in a
    text are ordinary text.

    A new word of Latin letters goes straight to a byte-pair merger that reads the
    file's vocabulary as ranks, the word's end as a byte of its own. Its ids equal
    the library's, since every entry of the vocabulary merges to itself (then no
    two neighbours that make up an entry are ever left over by its own merge). All
    other words go through the library.
    """

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        content = json.loads(spec)
        suffix = content["model"].get("end_of_word_suffix") or ""
        special = {t["content"] for t in content.get("added_tokens", [])}
        byte_of = byte_letters()
        ranks = {}
        for entry, i in content["model"]["vocab"].items():
            if entry not in special:
                ends = bool(suffix) and entry.endswith(suffix) and entry != suffix
                letters = entry.removesuffix(suffix) if ends else entry
                ranks[bytes(byte_of[c] for c in letters) + (WORD_END if ends else b"")] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece if suffix else None

    def _ids(self, words: Iterable[bytes]) -> None:
        """Learn words that need no further splitting, or only the library's."""
        rest = []
        for w in words:
            if self.merge is not None and w.isalpha():  # ASCII letters, in lower case already
                ids = self.merge(w + WORD_END)
            else:
                plain = w.decode().translate(_LOWER)
                if self.merge is None or not _LETTERS.fullmatch(plain):
                    rest.append(w)
                    continue
                ids = self.merge(plain.encode() + WORD_END)
            self.known[w] = struct.pack(f"<{len(ids)}I", *ids)
        for at in range(0, len(rest), 2_000):
            block = rest[at:at + 2_000]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in block], add_special_tokens=False)
            for w, e in zip(block, encoded, strict=True):
                self.known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def _learn(self, words: set[bytes], wanted: set[bytes]) -> None:
        """Learn new ``words``; where the memory is full, anew all that are ``wanted``."""
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
            words = wanted
        parts: dict[bytes, tuple[bytes, ...]] = {}
        single: set[bytes] = set()
        for w in words:
            core = w.strip(_EDGE_PUNCTUATION)
            if core and len(core) != len(w) and (core.isalpha() or _LETTERS.fullmatch(core.decode().translate(_LOWER))):
                head = w.index(core)  # the punctuation splits off
                parts[w] = tuple(x for x in (w[:head], core, w[head + len(core):]) if x)
                single.update(parts[w])
            else:
                single.add(w)
        self._ids(single.difference(self.known))
        for w, ps in parts.items():
            self.known[w] = b"".join([self.known[p] for p in ps])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        split = [t.lower().split() for t in texts]  # A-Z only; the file lower-cases anyway
        words: set[bytes] = set()
        for own in split:
            words.update(own)
        new = words.difference(self.known)
        if new:
            self._learn(new, words)
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in split]


_ENCODERS: dict[int, WordEncoder] = {}


def encoder(spec: str) -> WordEncoder:
    """One encoder per worker and tokenizer file."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


class _Packer:
    """Pieces of one task: waiting ones, and rows that are ready."""

    def __init__(self, first_sequence: int, window: int):
        self.sequence, self.window = first_sequence, window
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.waiting_tokens = 0
        self.full = BATCH_WINDOWS * (window - min(SLACK_TOKENS, window // 64))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self._put((doc_id, start, self.window, ids[4 * start:4 * (start + self.window)], total), 0)
            self.sequence += 1
        start = whole
        while start < total:
            length = min(PIECE_TOKENS, total - start, self.full - self.waiting_tokens)
            self.waiting.append((doc_id, start, length, ids[4 * start:4 * (start + length)], total))
            self.waiting_tokens += length
            start += length
            if self.waiting_tokens == self.full:
                self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        for part in windows([p[2] for p in self.waiting], self.window):
            pieces = [self.waiting[i] for i in part]
            for piece, end in zip(pieces, accumulate(p[2] for p in pieces), strict=True):
                self._put(piece, end - piece[2])
            self.sequence += 1
        self.waiting, self.waiting_tokens = [], 0

    def _put(self, piece: tuple, offset: int) -> None:
        doc_id, start, length, ids, total = piece
        self.rows.append((doc_id, start, length, zlib.crc32(ids), total, self.sequence, offset, ids))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
         with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    ``tokenizer`` is the path, on the driver, of a `tokenizers` file; its content
    goes to the tasks. Columns: doc_id, start (ids of its document before it),
    length, ids_crc32 (of its little-endian unsigned 32-bit ids), doc_tokens
    (with ``end_id``), sequence_id, offset (in its sequence, gapless from 0) and,
    with ``with_ids``, ids (array of int). Each id lies in exactly one piece.

    A null or empty text is one piece that holds ``end_id``. A null doc_id stays
    null. Each of repeated rows is packed. Extra columns are not carried. An empty
    table gives no pieces. A very long text gives whole windows and one tail.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    out = T.StructType.fromDDL(PIECE + (", ids array<int>" if with_ids else ""))
    arrow = to_arrow_schema(out)
    end = int(end_id).to_bytes(4, "little")

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(c, type=pa.int64()) for c in zip(*[r[:7] for r in rows], strict=True)]
        if with_ids:
            ends = np.cumsum([0] + [r[2] for r in rows], dtype=np.int32)
            values = np.frombuffer(b"".join([r[7] for r in rows]), dtype="<i4")
            cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).cast(arrow.field("ids").type))
        return pa.RecordBatch.from_arrays(cols, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(spec)
        packer = _Packer(TaskContext.get().partitionId() << 40, window)
        for part in slices(batches, "text"):
            texts = part.column(1).cast(pa.binary()).to_pylist()
            for doc_id, ids in zip(part.column(0).to_pylist(), words.encode(texts), strict=True):
                packer.add(doc_id, ids + end)
            if packer.rows:
                yield table(packer.rows)
                packer.rows = []
        packer.flush()
        if packer.rows:
            yield table(packer.rows)

    return whole_texts(docs, id_col, text_col).mapInArrow(run, out)
