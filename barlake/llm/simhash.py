"""SimHash near-duplicates: binary tries joined with themselves.

A fingerprint is 64 bits over word shingles. Distinct fingerprints are dealt
into many small tries and each trie is joined with itself: node pairs go down
together, differing bits add up, and a pair beyond the error budget is pruned.

Dealing: with a budget of ``d`` bits, cut the 64 bits into ``d + 1`` blocks. Two
fingerprints within the budget agree in one block at least, and again, of the
``d + 1`` blocks of the other bits, in one at least. So ``(d + 1) ** 2`` tries,
each of the fingerprints that agree in two such blocks (28 bits for ``d`` = 3),
meet every pair. A trie with more than ``HOT_BUCKET`` fingerprints is dealt out
again by the same rule over its remaining bits, until at most ``SMALL_TAIL``
bits are open, which bounds a trie by 2 ** ``SMALL_TAIL`` entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import cut, map_texts, sorted_groups, temp_name, whole_texts
from barlake.llm.components import EDGE, components, star

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
HOT_BUCKET = 50_000
SMALL_TAIL = 21
#: Node pairs and shingles handled at once in a task.
PAIRS_AT_ONCE = 400_000
SHINGLES_AT_ONCE = 100_000


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a UTF-8 text (lower-cased A-Z, ASCII white space)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        block = slice(at, at + SHINGLES_AT_ONCE)
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[block], ends[block], strict=True)])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id long, text_key long, fp long): one row per input row. ``text_key``
    is a hash of the text, to find the row again. Null or empty text: ``fp`` 0."""
    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "text_key": cols["text_key"],
                             "fp": [fingerprint(t, width) for t in cols["text"]]}

    texts = whole_texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return map_texts(texts, make, "doc_id long, text_key long, fp long", binary=True)


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, size) of ``parts`` blocks that cover ``bits`` bits."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _deal(rows: DataFrame, open_bits: int, budget: int) -> DataFrame:
    """Each row once per block of its open bits: the block moves from ``tail``
    to ``head``. Blocks differ in size by one bit at most; the largest is cut to
    the smallest, so that every table keeps the same number of open bits."""
    parts = budget + 1
    size = open_bits // parts
    tail = F.col("tail")

    def moved(i: int, lo: int) -> Column:
        piece = F.shiftrightunsigned(tail, lo).bitwiseAND((1 << size) - 1)
        high = F.shiftleft(F.shiftrightunsigned(tail, lo + size), lo) if lo + size < 64 else F.lit(0).cast("long")
        low = tail.bitwiseAND((1 << lo) - 1)
        return F.struct((F.col("trie") * parts + i).alias("trie"),
                        F.shiftleft(F.col("head"), size).bitwiseOR(piece).alias("head"),
                        high.bitwiseOR(low).alias("tail"))

    options = F.array(*[moved(i, lo) for i, (lo, _) in enumerate(_blocks(open_bits, parts))])
    return rows.select("fp", F.explode(options).alias("x")).select("fp", "x.trie", "x.head", "x.tail")


def trie_pairs(tails: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int,
               budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of entries that differ in at most ``budget`` bits.

    ``tails`` is sorted and distinct inside each range [start, end), which is the
    root of one trie; a node is a range, and its children are told apart by the
    next bit. Pairs of nodes wait on a stack in blocks of bounded size.
    """
    ones: dict[int, np.ndarray] = {}

    def split(bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((tails >> bit) & 1)]).astype(np.int32)
        return hi - (ones[bit][hi] - ones[bit][lo])

    big = ends - starts > 1
    starts, ends = starts[big], ends[big]
    stack = [(bits - 1, starts, ends, starts, ends, np.zeros(len(starts), dtype=np.int8))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > PAIRS_AT_ONCE:
            mid = len(alo) // 2
            stack.append((bit, *(x[mid:] for x in (alo, ahi, blo, bhi, err))))
            stack.append((bit, *(x[:mid] for x in (alo, ahi, blo, bhi, err))))
            continue
        if not len(alo):
            continue
        if bit < 0:
            yield alo, blo
            continue
        amid, bmid = split(bit, alo, ahi), split(bit, blo, bhi)
        own = alo == blo
        kids = [(alo, amid, blo, bmid, err, None), (amid, ahi, bmid, bhi, err, None),
                (alo, amid, bmid, bhi, err + 1, None), (amid, ahi, blo, bmid, err + 1, ~own)]
        kept = []
        for a0, a1, b0, b1, e, also in kids:
            keep = (a1 > a0) & (b1 > b0) & (e <= budget) & ~((a0 == b0) & (a1 - a0 < 2))
            if also is not None:
                keep &= also
            kept.append([x[keep] for x in (a0, a1, b0, b1, e)])
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*kept, strict=True))))


def _join_tries(budget: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, ("trie", "head")):
            n = len(block["fp"])
            if n < 2:
                continue
            new = np.ones(n, dtype=bool)
            new[1:] = (block["trie"][1:] != block["trie"][:-1]) | (block["head"][1:] != block["head"][:-1])
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], n)
            for i, j in trie_pairs(block["tail"], starts, ends, bits, budget):
                node, least = star(block["fp"][i], block["fp"][j])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["a", "b"])
    return run


def links(distinct_fps: DataFrame, budget: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """(a long, b long): links that span the same components as all pairs of
    fingerprints (one long column, distinct) within ``budget`` bits."""
    if not 1 <= budget <= 7:
        raise ValueError("the error budget is 1 to 7 bits")
    name = distinct_fps.columns[0]
    # The top bit is the sign: with the budget's blocks it is one bit like any other.
    rows = distinct_fps.select(F.col(name).alias("fp"), F.lit(1).cast("long").alias("trie"),
                               F.lit(0).cast("long").alias("head"), F.col(name).alias("tail"))
    bits = 64
    rows = _deal(rows, bits, budget)
    bits -= bits // (budget + 1)
    rows = _deal(rows, bits, budget)
    bits -= bits // (budget + 1)
    widest, parts = bits, []
    while bits > SMALL_TAIL and bits // (budget + 1) > 0:
        sizes = rows.groupBy("trie", "head").count().filter(F.col("count") > hot).drop("count")
        if sizes.isEmpty():
            break
        parts.append(rows.join(sizes, ["trie", "head"], "left_anti").select("fp", "trie", "head", "tail"))
        rows = _deal(rows.join(sizes, ["trie", "head"], "left_semi"), bits, budget)
        bits -= bits // (budget + 1)
    parts.append(rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.repartition("trie", "head").sortWithinPartitions("trie", "head", "tail")
            .mapInArrow(_join_tries(budget, widest), EDGE))


def _classes(docs: DataFrame, width: int, budget: int, id_col: str, text_col: str,
             hot: int) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id); root is never null."""
    fps = cut(fingerprints(docs, width, id_col, text_col))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), budget, hot))
    named = cut(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(named.join(names, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, budget: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_BUCKET) -> DataFrame:
    """(doc_id long, fingerprint string, component_id long), one row per input row.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``budget`` differing bits. Null or empty texts have fingerprint zero and link
    like any other. Repeated rows stay repeated. A null doc_id stays null and is
    never a component's name (a component of null ids only has none). Extra
    columns are not carried. An empty table gives an empty result.
    """
    return _classes(docs, width, budget, id_col, text_col, hot).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = SHINGLE_WORDS, budget: int = MAX_BITS,
               id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_BUCKET) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest doc_id.

    All columns stay, whatever their names. Of rows with equal id and text one
    stays. Rows with a null doc_id stay only if their component has no other id.
    """
    found = _classes(docs, width, budget, id_col, text_col, hot)

    def key(doc_id: Column, text_key: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), text_key.cast("string"))

    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                                                    "text_key")).alias("x"))
    own, rank = temp_name(docs, "row_key"), temp_name(docs, "row_rank")
    kept = best.select(key(F.col("x.doc_id"), F.col("x.text_key")).alias(own))
    keyed = docs.withColumn(own, key(F.col(id_col).cast("long"),
                                     F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    rows = keyed.join(kept, own).withColumn(rank, F.row_number().over(Window.partitionBy(own).orderBy(own)))
    return rows.filter(F.col(rank) == 1).select(*docs.columns)
