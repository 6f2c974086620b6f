"""Embedding near-duplicates: random hyperplanes, exact cosines, components.

Equal vectors are one node. Random hyperplanes give each node a key of sign bits
in each of several tables; nodes of one bucket (equal keys in a table) are
compared by cosine in double precision. A pair that meets in several tables is
counted in the first of them. Buckets are cut into blocks, and a task compares
one block with itself or with another, so a bucket is never gathered whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import cut, sorted_groups
from barlake.llm.components import components, star

THRESHOLD = 0.9
#: Wanted chance that a pair just at the threshold meets in some table.
RECALL = 0.999
#: Nodes that a bucket of unrelated vectors should hold, and the size of a block.
BUCKET, BLOCK = 256, 1024
SEED = 17


def layout(nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a key, tables): keys grow with the logarithm of the number of nodes,
    the tables as many as the wanted recall needs for keys of that many bits."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, nodes) / BUCKET))))
    same = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    tables = 1 if same >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - same))
    return bits, max(1, tables)


def _usable(vector: Column) -> Column:
    """Not null, all components finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _keys(bits: int, tables: int, seed: int):
    """Keys of each vector in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            keys = np.zeros((batch.num_rows, tables), dtype=np.int64)
            for size in np.unique(sizes).tolist():
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).normal(size=(size, bits * tables))
                rows = np.flatnonzero(sizes == size)
                x = _matrix(vectors.take(pa.array(rows)), size)
                scale = np.abs(x).max(axis=1, keepdims=True)  # no overflow of very large components
                signs = ((x / scale) @ planes[size] > 0).reshape(len(rows), tables, bits)
                keys[rows] = (signs * weights).sum(axis=2)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().astype(np.int32)))],
                names=["node", "keys"])
    return run


def _compare(threshold: float):
    """Links of one block with itself or another: (node, other, 0) links that span
    the bucket's components, and (node, number of rows it is linked to, 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, ("size", "table", "key", "a", "b")):
            n = len(block["node"])
            names = ("size", "table", "key", "a", "b")
            change = np.zeros(n - 1, dtype=bool)
            for k in names:
                change |= block[k][1:] != block[k][:-1]
            cuts = np.r_[0, np.flatnonzero(change) + 1, n]
            out_a, out_b, out_kind = [], [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi - lo < 2:
                    continue
                x = np.stack(block["vec"][lo:hi]).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                keys, node, times = np.stack(block["keys"][lo:hi]), block["node"][lo:hi], block["times"][lo:hi]
                if block["a"][lo] == block["b"][lo]:
                    left = right = np.arange(hi - lo)
                else:
                    left = np.flatnonzero(block["block"][lo:hi] == block["a"][lo])
                    right = np.flatnonzero(block["block"][lo:hi] == block["b"][lo])
                i, j = np.nonzero(x[left] @ x[right].T >= threshold)
                i, j = left[i], right[j]
                if left is right:
                    i, j = i[i < j], j[i < j]
                before = int(block["table"][lo])
                if before and len(i):  # met in an earlier table
                    fresh = np.ones(len(i), dtype=bool)
                    for at in range(before):
                        fresh &= keys[i, at] != keys[j, at]
                    i, j = i[fresh], j[fresh]
                if not len(i):
                    continue
                a, b = star(node[i], node[j])
                total = np.bincount(i, times[j], hi - lo) + np.bincount(j, times[i], hi - lo)
                linked = np.flatnonzero(total)
                out_a += [a, node[linked]]
                out_b += [b, total[linked].astype(np.int64)]
                out_kind += [np.zeros(len(a), dtype=np.int32), np.ones(len(linked), dtype=np.int32)]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (out_a, out_b, out_kind)],
                                                 names=["a", "b", "kind"])
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED,
                    id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(vec_id long, n_links long, component_id long, kept boolean), a row per row.

    Rows link at a cosine of at least ``threshold``; ``recall`` is the least
    expected share of such pairs that is found (pairs above the threshold are found
    with a higher chance, none below it is linked). ``n_links`` counts rows, equal
    vectors included. ``component_id`` is the smallest vec_id reachable, itself
    included. Null, empty and zero vectors, and those with null or non-finite
    components, link with nothing; vectors of other lengths do not link. Repeated
    rows stay; a null vec_id stays null, names no component and is never kept
    (unless alone it has no component). Extra columns are not carried. An empty
    table gives an empty result.
    """
    vector = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vec"))
    usable = F.when(_usable(F.col("vec")), F.transform("vec", lambda x: x + 0))  # -0.0 becomes 0.0
    rows = rows.select("vec_id", usable.alias("vec")).select(
        "vec_id", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("node"), "vec")
    nodes = cut(rows.filter("vec IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("times"), F.first("vec").alias("vec")))
    bits, tables = layout(nodes.count(), threshold, recall)
    keyed = cut(nodes.select("node", "vec").mapInArrow(_keys(bits, tables, seed), "node long, keys array<int>"))
    placed = keyed.select("node", F.posexplode("keys").alias("table", "key"))
    sizes = placed.groupBy("table", "key").agg(F.count("*").alias("members")).filter("members > 1")
    n = F.ceil(F.col("members") / block).cast("int")
    blocked = (placed.join(sizes, ["table", "key"])
               .select("node", "table", "key", n.alias("n"), F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int").alias("block"))
               .select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
               .select("node", "table", "key", "block", F.least("block", "other").alias("a"),
                       F.greatest("block", "other").alias("b")))
    full = nodes.select("node", "times", "vec", F.size("vec").alias("size")).join(keyed, "node")
    groups = ["size", "table", "key", "a", "b"]
    found = cut(blocked.join(full, "node").select(*groups, "block", "node", "times", "vec", "keys")
                .repartition(*groups).sortWithinPartitions(*groups)
                .mapInArrow(_compare(threshold), "a long, b long, kind int"))
    counts = found.filter("kind = 1").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    roots = components(found.filter("kind = 0").select("a", "b"))
    named = cut(nodes.select("node", "least", "times").join(roots, "node", "left").join(counts, "node", "left")
                .select("node", "least", F.coalesce("root", "node").alias("root"),
                        (F.col("times") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = named.join(names, "root").select("node", "n_links", "component_id")
    linked = rows.filter("node IS NOT NULL").select("vec_id", "node").join(by_node, "node").select(
        "vec_id", "n_links", "component_id")
    alone = rows.filter("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
