"""Connected components: numpy inside a task, alternating stars across tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import cut

EDGE = "a long, b long"


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links (a, b)."""
    parent = np.arange(n)
    while len(a):
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as links (a, b), with one link per node: (node, smallest)."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(len(nodes), inverse[:len(a)], inverse[len(a):])
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            node, least = star(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node long, root long) for every node that has a smaller node reachable.

    ``links`` has two long columns; repeats and self links are fine, nulls are
    ignored. Nodes that are the smallest of their component, and nodes without
    links, have no row. Alternates large-star and small-star steps until the
    links no longer change. A hub is never gathered in one group: its smallest
    neighbour is a map-side combined aggregate, and the join back on the hub is
    one that AQE splits. Each round is checkpointed in the shared folder.
    """
    first, second = links.columns[:2]
    edges = (links.select(F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b"))
             .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    edges = cut(edges.mapInArrow(_contract, EDGE).distinct())

    def print_of(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        row = df.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))).first()
        return tuple(row)

    seen = print_of(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array("a", "b")).alias("v"), "m")
                 .filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        edges = cut(small)
        now = print_of(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
