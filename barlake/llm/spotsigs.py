"""Document fingerprints: SpotSigs.

Where a common word (an anchor) stands, it and the chain of content words that
follow it form a signature; a text's fingerprint is its set of signatures. Anchors
are the common words of four languages, and of any language (or code) one content
word in ``EVERY``, chosen by its hash: one rule for all texts, so a text that loses a
common word loses that word's signature and no other. Two
sets are compared by Jaccard. For a threshold, sets are partitioned by length so
that only sets of one partition and the next can reach it, and a comparison stops
as soon as the threshold is out of reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.llm.common import cut, map_texts, slices, sorted_groups, whole_texts
from barlake.llm.components import EDGE, components, star

CHAIN = 2
#: One content word in so many is an anchor too.
EVERY = 8
# Anchors, common words of four languages.
ANCHORS = frozenset(w.encode() for w in (
    "the of and to in a is it that for was on with as be by this are at from or an not have had but which "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an dem "
    "le la les de des et un une que est dans pour qui sur pas par ce il elle en du au "
    "el los las y del se por con una su lo como más pero sus"
).split())
#: A-Z in lower case, every other ASCII character that is no letter or digit a blank.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))
THRESHOLD = 0.8
#: Members of one bucket compared at once, as blocks against blocks.
BLOCK = 512


def signatures(text: bytes, chain: int = CHAIN) -> set[int]:
    """32-bit hashes of a UTF-8 text's signatures. A text without words has its runs
    between white space for words. Words without any anchor among them (a few words)
    give a kind of their own, the chain that starts at each word; an empty text has no
    signatures."""
    words = text.translate(_TO_WORDS).split() or text.split()
    content: list[bytes] = []
    spots: list[tuple[bytes, int]] = []
    digest = xxhash.xxh32_intdigest
    for w in words:
        if w in ANCHORS:
            spots.append((w, len(content)))
        else:
            content.append(w)
            if digest(w) % EVERY == 0:
                spots.append((w, len(content)))
    if not spots:
        return {digest(b"\0" + b" ".join(words[i:i + chain + 1])) for i in range(len(words))}
    return {digest(b" ".join([anchor, *content[k:k + chain]])) for anchor, k in spots}


def fingerprint(sigs: set[int]) -> str:
    """The signatures in order, eight hexadecimal digits each."""
    return np.array(sorted(sigs), dtype=">u4").tobytes().hex()


def jaccard(a: set[int], b: set[int], floor: float = 0.0) -> float:
    """Likeness of two sets, 0 if it is below ``floor``: the sets' lengths alone may
    tell, else the count of missing members does. Two empty sets are alike."""
    if not a and not b:
        return 1.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < floor * len(large) or not small:
        return 0.0
    if floor > 0:
        allowed = len(small) - floor * (len(small) + len(large)) / (1 + floor)
        missing = 0
        for s in small:
            if s not in large:
                missing += 1
                if missing > allowed + 1e-9:
                    return 0.0
        common = len(small) - missing
    else:
        common = len(small & large)
    return common / (len(small) + len(large) - common)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def compare_with_next(docs: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The next document is the one of the next doc_id in ascending order (after the
    last: the first; of rows with equal ids, in the order of their texts; null ids
    come first). Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null texts are empty; two texts
    without signatures are alike (1). Repeated rows stay, extra columns are not
    carried, an empty table gives an empty result, one row follows itself. Very long
    texts are read whole, one at a time.

    Texts are shuffled once, to ranges of ids: the ranges' first ids are quantiles,
    so a range's first row is known by its id and also sent to the range before.
    """
    spark = docs.sparkSession
    texts = whole_texts(docs, id_col, text_col)
    lowest = -(2 ** 63)
    keyed = texts.select(F.coalesce("doc_id", F.lit(lowest)).alias("key"), "doc_id", "text")
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keyed.agg(F.percentile_approx("key", [i / n for i in range(n)], max(10_000, 10 * n)).alias("q"),
                      F.min("key").alias("least")).first()
    bounds = np.array(sorted({*(found["q"] or []), found["least"]} - {None}), dtype=np.int64)
    dealt = T.StructType.fromDDL("part int, look int, key long, doc_id long, text string")
    dealt_arrow, out_arrow = to_arrow_schema(dealt), to_arrow_schema(T.StructType.fromDDL(COMPARED))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            key = batch.column(0).to_numpy()
            part = np.searchsorted(bounds, key, side="right") - 1
            first = np.flatnonzero(bounds[part] == key)
            rows = np.concatenate([np.arange(len(key)), first])
            look = np.zeros(len(rows), dtype=np.int32)
            look[len(key):] = 1
            to = np.concatenate([part, (part[first] - 1) % len(bounds)]).astype(np.int32)
            taken = [c.take(pa.array(rows)) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(look), *taken], schema=dealt_arrow)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, done = None, None, False
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            cols = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(),
                    batch.column(4).to_pylist()]
            for p, look, doc_id, text in zip(*cols, strict=True):
                if p != part:
                    part, waiting, done = p, None, False
                if done:
                    continue  # only the first row that looks ahead counts
                sigs = signatures(text.encode(), chain)
                if waiting is not None:
                    own_id, own_text, own = waiting
                    other = edited(own_text, text)
                    changed = signatures(other.encode(), chain)
                    rows.append((own_id, len(own_text), hashlib.sha256(other.encode()).hexdigest(), fingerprint(own),
                                 fingerprint(changed), jaccard(own, changed), jaccard(own, sigs)))
                waiting, done = (doc_id, text, sigs), look == 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), out_arrow, strict=True)],
                    schema=out_arrow)

    return (keyed.mapInArrow(deal, dealt).repartition("part")
            .sortWithinPartitions("part", "look", "key", "text").mapInArrow(compare, COMPARED))


def fingerprints(docs: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, size int, sigs array<long>): sorted signatures of each row."""
    def make() -> Callable:
        def run(cols: dict) -> dict:
            sets = [sorted(signatures(t, chain)) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "size": [len(s) for s in sets], "sigs": sets}
        return run
    return map_texts(whole_texts(docs, id_col, text_col), make, "doc_id long, size int, sigs array<long>", binary=True)


def _compare_buckets(threshold: float):
    """Links inside buckets of (key, a block, b block): members of one block against
    each other, or of the lower block against the higher."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, ("band", "sig", "a", "b")):
            n = len(block["node"])
            keys = np.stack([block[k] for k in ("band", "sig", "a", "b")])
            cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0), True]) if n else [0]
            left, right = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                sets = [set(s.tolist()) for s in block["sigs"][lo:hi]]
                node, part = block["node"][lo:hi], block["block"][lo:hi]
                same = block["a"][lo] == block["b"][lo]
                group = np.arange(hi - lo)  # members linked here already need no comparison
                for j in range(hi - lo):
                    for i in range(j):
                        if group[i] == group[j] or (not same and part[i] == part[j]):
                            continue
                        if jaccard(sets[i], sets[j], threshold) > 0:
                            left.append(node[i])
                            right.append(node[j])
                            group[group == group[j]] = group[i]
            if left:
                a, b = star(np.array(left), np.array(right))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, chain: int = CHAIN, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id long, class_id long): class_id is the smallest doc_id reachable over
    pairs whose likeness is at least ``threshold`` (0 < threshold <= 1).

    Equal sets are one node. Nodes are partitioned by length; a node meets those of
    its own partition and of the next lower one that hold one of its rarest
    signatures (as many as must include a common one). Buckets are compared in
    blocks, so none is gathered whole. Texts without signatures are one class.
    Null ids stay null and name no class. Extra columns are not carried.
    """
    sets = cut(fingerprints(docs, chain, id_col, text_col).withColumn("node", F.xxhash64("sigs")))
    nodes = sets.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"),
                                     F.first("sigs").alias("sigs"))
    nodes = cut(nodes)
    band = F.floor(F.log("size") / -np.log(threshold)) if threshold < 1 else F.col("size")
    tokens = (nodes.filter("size > 0").select("node", "size", band.cast("long").alias("own"), F.explode("sigs").alias("sig")))
    common = tokens.groupBy("sig").agg(F.count("*").alias("df"))
    ranked = (tokens.join(common, "sig").groupBy("node", "size", "own")
              .agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("by_df")))  # at most one set
    rare = F.slice("by_df", F.lit(1), F.col("size") - F.ceil(F.col("size") * threshold - 1e-9).cast("int") + 1)
    bands = F.array("own", F.col("own") + 1) if threshold < 1 else F.array("own")
    placed = (ranked.select("node", F.explode(rare).alias("x"), bands.alias("bands"))
              .select("node", F.col("x.sig").alias("sig"), F.explode("bands").alias("band")))
    sizes = placed.groupBy("band", "sig").agg(F.count("*").alias("members")).filter("members > 1")
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    blocked = (placed.join(sizes, ["band", "sig"])
               .select("band", "sig", "node", n_blocks.alias("n"), F.pmod(F.xxhash64("node"), n_blocks).cast("int").alias("block"))
               .select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
               .select("band", "sig", "node", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")))
    links = (blocked.join(nodes.select("node", "sigs"), "node").repartition("band", "sig", "a", "b")
             .sortWithinPartitions("band", "sig", "a", "b", "node").mapInArrow(_compare_buckets(threshold), EDGE))
    roots = components(links)
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("class_id"))
    return sets.join(named.join(names, "root").select("node", "class_id"), "node").select("doc_id", "class_id")
