"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers (``floor(256 * x)``), are sorted along a Hilbert curve and
cut into blocks, each one row of a Parquet table in the shared folder: its vectors,
and its zone map, the least and greatest value of every dimension, with its rows by
label. From a zone map, interval arithmetic bounds the score of an anchor with any
row of the block. The bounds of all blocks give a floor under the scores that an
anchor's result can hold; a block whose upper bound is below the floor, or whose
whole interval lies outside every window, is not read for that anchor. The zone
maps are a few columns of the table, so choosing blocks never opens the vectors.

Two rounds: the first finds the positives, the second the negatives in the windows
that the positives' scores set. In each, anchors go to the shards (groups of
consecutive blocks) that hold a block they need, and meet them there block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.session import scratch_path

# Quantisation, relabelling, anchors, windows, how many are wanted.
SCALE = 256
RELABEL_EVERY, LABELS = 7, 10
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100
#: Bytes of a block's vectors as doubles (a row at least); blocks of a shard.
BLOCK_BYTES, SHARD_BLOCKS = 128 * 1024, 256
#: Rows of zone maps that a planning task holds against its anchors.
ZONE_ROWS = 4096
#: Anchors that a planning task should have before zone maps are copied to another.
PLAN_ANCHORS = 1024
#: Bits of each dimension on the curve.
CURVE_BITS = 2
#: Integers up to this size multiply and add exactly in double precision.
EXACT = 2**53
LONG_MAX = 2**63 - 1

LONG, INT, BYTES = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


ROWS = _schema(("id", LONG), ("label", LONG), ("dim", INT), ("curve", BYTES), ("vector", BYTES))
BLOCKS = _schema(("shard", LONG), ("block", INT), ("dim", INT), ("rows", INT), ("lo", BYTES), ("hi", BYTES),
                 ("labels", BYTES), ("counts", BYTES), ("ids", BYTES), ("row_labels", BYTES),
                 ("width", INT), ("vectors", BYTES))
PLAN = _schema(("anchor", LONG), ("shard", LONG), ("blocks", T.ArrayType(INT)))
SCORED = _schema(("anchor", LONG), ("window", INT), ("id", LONG), ("score", LONG))


# ------------------------------------------------------------------ vectors --

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of cell numbers (below 2**bits) -> big-endian bytes of their places on the
    Hilbert curve through all cells: Gray code undone from the highest bit downwards."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            high = (x[i] >> b) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= np.where(high, 0, swap) if i else 0
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        t = np.where((x[d - 1] >> b) & 1 == 1, t ^ ((1 << b) - 1), t)
    x ^= t
    planes = np.stack([(x[i] >> b) & 1 for b in range(bits - 1, -1, -1) for i in range(d)], axis=1)
    return np.packbits(planes.astype(np.uint8), axis=1)


def _curve_keys(v: np.ndarray) -> list[bytes]:
    """Places of vectors on the curve; cells follow each vector's own mean size, so that
    its scale does not matter."""
    if v.shape[1] == 0:
        return [b""] * len(v)
    size = np.abs(v).mean(axis=1, keepdims=True)
    cells = (v >= 0).astype(np.int64) * 2 + np.where(v >= 0, v > size, v > -size)
    return [bytes(r) for r in hilbert(cells, CURVE_BITS)]


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(ROWS)
    for batch in batches:
        ids, labels, vectors = [], [], []
        for i, label, vec in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
                continue
            with np.errstate(over="ignore"):
                v = np.floor(np.asarray(vec, np.float64) * SCALE) + 0.0
            ids.append(i)
            labels.append(int(math.fmod(label + 1, LABELS)) if i % RELABEL_EVERY == 0 else label)
            vectors.append(np.clip(v, -np.finfo(np.float64).max, np.finfo(np.float64).max))
        out = {"id": ids, "label": labels, "dim": [len(v) for v in vectors], "curve": [b""] * len(ids),
               "vector": [v.tobytes() for v in vectors]}
        for dim in set(out["dim"]):
            at = [k for k, d in enumerate(out["dim"]) if d == dim]
            for k, key in zip(at, _curve_keys(np.stack([vectors[k] for k in at])), strict=True):
                out["curve"][k] = key
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)


def quantised(embeddings: DataFrame) -> DataFrame:
    """(id, label, dim, curve, vector): rows that take part, as exact integers in doubles."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_integers, ROWS)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products (anchors x rows); what a long cannot hold is its nearest end."""
    if anchors.shape[1] == 0:
        return np.zeros((len(anchors), len(rows)), np.int64)
    biggest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if biggest < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows]
    return np.array([[max(-LONG_MAX, min(LONG_MAX, sum(int(x) * y for x, y in zip(a, r, strict=True)))) for r in whole]
                     for a in anchors], np.int64).reshape(len(anchors), len(rows))


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score (anchors x zones) that interval arithmetic allows, rounded outwards."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
        slack = 2.0**-40 * (np.abs(anchors) @ np.maximum(np.abs(lo), np.abs(hi)).T)
        sure = slack * 2.0**40 < EXACT
        least, most = np.where(sure, least, least - slack), np.where(sure, most, most + slack)
    return (np.clip(np.where(np.isnan(least), -np.inf, least), -LONG_MAX, LONG_MAX),
            np.clip(np.where(np.isnan(most), np.inf, most), -LONG_MAX, LONG_MAX))


def packed(v: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in the fewest bytes each that hold them: 2 or 4 as integers, else 8 as doubles."""
    for width, kind in ((2, np.int16), (4, np.int32)):
        if np.abs(v).max(initial=0) <= np.iinfo(kind).max:
            return width, v.astype(kind).tobytes()
    return 8, v.tobytes()


def unpacked(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, {2: np.int16, 4: np.int32, 8: np.float64}[width]).astype(np.float64)


# ------------------------------------------------------------------- blocks --

def _blocks(block_bytes: int, shard_blocks: int):
    arrow = to_arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            nonlocal held, made
            v = np.stack([np.frombuffer(r["vector"]) for r in held])
            labels = np.array([r["label"] for r in held], np.int64)
            kinds, counts = np.unique(labels, return_counts=True)
            width, vectors = packed(v)
            row = {"shard": (part << 32) + made // shard_blocks, "block": made % shard_blocks, "dim": v.shape[1], "rows": len(v),
                   "lo": v.min(axis=0).tobytes(), "hi": v.max(axis=0).tobytes(), "labels": kinds.tobytes(),
                   "counts": counts.astype(np.int64).tobytes(), "ids": np.array([r["id"] for r in held], np.int64).tobytes(),
                   "row_labels": labels.tobytes(), "width": width, "vectors": vectors}
            held, made = [], made + 1
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if held and (len(held) * 8 * max(1, r["dim"]) >= block_bytes or held[-1]["dim"] != r["dim"]):
                    yield block()
                held.append(r)
        if held:
            yield block()

    return run


def write_blocks(rows: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, shard_blocks: int = SHARD_BLOCKS) -> None:
    """The block table: rows in the order of the curve (a common vector is spread by its
    ids), one Parquet row per block."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "curve", "id", "label"]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .mapInArrow(_blocks(block_bytes, shard_blocks), BLOCKS).write.option("compression", "zstd").parquet(path))


# ----------------------------------------------------------------- planning --

def _floor(values: np.ndarray, counts: np.ndarray, wanted: int | np.ndarray) -> np.ndarray:
    """Per anchor (row) the greatest value v such that entries >= v hold ``wanted`` rows
    (minus infinity where all together hold fewer)."""
    order = np.argsort(-values, axis=1, kind="stable")
    enough = np.cumsum(np.take_along_axis(counts, order, 1), axis=1) >= np.reshape(wanted, (-1, 1))
    first = np.argmax(enough, axis=1)
    found = np.take_along_axis(np.take_along_axis(values, order, 1), first[:, None], 1)[:, 0]
    return np.where(enough.any(axis=1), found, -np.inf)


def _zones(rows: list[dict], dim: int) -> dict:
    own = [r for r in rows if r["dim"] == dim]
    by_label: dict[int, np.ndarray] = {}
    for k, r in enumerate(own):
        for label, n in zip(np.frombuffer(r["labels"], np.int64).tolist(), np.frombuffer(r["counts"], np.int64), strict=True):
            by_label.setdefault(label, np.zeros(len(own), np.int64))[k] = n
    return {"shard": np.array([r["shard"] for r in own], np.int64), "block": np.array([r["block"] for r in own], np.int64),
            "lo": np.array([np.frombuffer(r["lo"]) for r in own]).reshape(len(own), dim),
            "hi": np.array([np.frombuffer(r["hi"]) for r in own]).reshape(len(own), dim),
            "rows": np.array([r["rows"] for r in own], np.int64),
            "by_label": by_label}


def _wanted_blocks(vectors: np.ndarray, labels: list[int], copies: np.ndarray, windows: list | None, zones: dict) -> np.ndarray:
    """Which zones (columns) each anchor (row) must read: for its positives, or where
    ``windows`` are given (per anchor a list of lowest and highest score) for its negatives."""
    least, most = bounds(vectors, zones["lo"], zones["hi"])
    none = np.zeros(len(zones["rows"]), np.int64)
    same = np.stack([zones["by_label"].get(k, none) for k in labels])
    if windows is None:
        # Rows of the anchor's own vec_id may be among those of its label.
        floor = _floor(np.where(same > 0, least, -np.inf), same, POSITIVES + copies)
        return (same > 0) & (most >= floor[:, None])
    other = zones["rows"][None, :] - same
    need = np.zeros(least.shape, bool)
    for k, own in enumerate(windows):
        for lowest, highest in own:
            meets = (other[k] > 0) & (most[k] >= lowest) & (least[k] <= highest)
            inside = meets & (least[k] >= lowest) & (most[k] <= highest)
            floor = _floor(np.where(inside, least[k], -np.inf)[None], np.where(inside, other[k], 0)[None], NEGATIVES)[0]
            need[k] |= meets & (most[k] >= floor)
    return need


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, kind 0 zone map or 1 anchor, ...) sorted by group and kind -> the blocks of
    the group that each anchor must read, by shard."""
    arrow = to_arrow_schema(PLAN)
    group, zones, by_dim = None, [], {}
    for batch in batches:
        anchors, out = {}, []
        for r in batch.to_pylist():
            if r["group"] != group:
                _decide(anchors, by_dim, zones, out)
                anchors, group, zones, by_dim = {}, r["group"], [], {}
            if r["kind"] == 0:
                zones.append(r)
            else:
                anchors.setdefault(r["dim"], []).append(r)
        _decide(anchors, by_dim, zones, out)
        yield pa.RecordBatch.from_pylist(out, schema=arrow)


def _decide(anchors: dict, by_dim: dict, zones: list[dict], out: list[dict]) -> None:
    for dim, rows in anchors.items():
        if dim not in by_dim:
            by_dim[dim] = _zones(zones, dim)
        z = by_dim[dim]
        if not len(z["rows"]):
            continue
        vectors = np.array([np.frombuffer(r["vector"]) for r in rows]).reshape(len(rows), dim)
        windows = None if rows[0]["windows"] is None else [[(w["lowest"], w["highest"]) for w in r["windows"]] for r in rows]
        need = _wanted_blocks(vectors, [r["label"] for r in rows], np.array([r["copies"] for r in rows]), windows, z)
        for k, r in enumerate(rows):
            at = np.flatnonzero(need[k])
            for shard in np.unique(z["shard"][at]):
                out.append({"anchor": r["anchor"], "shard": int(shard),
                            "blocks": z["block"][at[z["shard"][at] == shard]].tolist()})


WINDOWS = "array<struct<window:int,lowest:long,highest:long>>"
ZONE_COLUMNS = ["shard", "block", "dim", "rows", "lo", "hi", "labels", "counts"]


def plan_reads(anchors: DataFrame, blocks: DataFrame, zone_rows: int = ZONE_ROWS) -> DataFrame:
    """(anchor, shard, blocks): zone maps in groups of at most about ``zone_rows``, every
    anchor against every group. (A stated query set against all zones.)"""
    zones = blocks.select(*ZONE_COLUMNS)
    groups = max(1, -(-zones.count() // zone_rows))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A group's zones go to as many tasks as its anchors can fill, so few groups still use the cluster.
    share = max(1, min(n // groups, -(-anchors.count() // PLAN_ANCHORS)))
    first = F.col("g") * share
    z = zones.withColumn("g", F.pmod(F.xxhash64("shard", "block"), F.lit(groups))).select(
        F.explode(F.sequence(first, first + F.lit(share - 1))).alias("group"), F.lit(0).alias("kind"), *ZONE_COLUMNS,
        *_nulls(anchor="long", label="long", copies="long", vector="binary", windows=WINDOWS))
    a = anchors.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g")).select(
        (first + F.pmod(F.xxhash64("anchor"), F.lit(share))).alias("group"), F.lit(1).alias("kind"), "dim", "anchor", "label", "copies", "vector", "windows",
        *_nulls(shard="long", block="int", rows="int", lo="binary", hi="binary", labels="binary", counts="binary"))
    return z.unionByName(a).repartition(n, "group").sortWithinPartitions("group", "kind").mapInArrow(_plan, PLAN)


def _nulls(**kinds: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]


# ------------------------------------------------------------------ reading --

def _best(found: list[tuple[int, int]], wanted: int) -> list[tuple[int, int]]:
    return sorted(found, key=lambda p: (-p[0], p[1]))[:wanted]


def _tops(score: np.ndarray, ids: np.ndarray, keep: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    at = np.flatnonzero(keep)
    if len(at) > wanted:
        s = score[at]
        at = at[s >= np.partition(s, len(s) - wanted)[len(s) - wanted]]
    return _best([(int(score[i]), int(ids[i])) for i in at], wanted)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, kind 0 block or 1 anchor, ...) sorted by shard and kind -> the best rows of
    the shard for each anchor and window."""
    arrow = to_arrow_schema(SCORED)
    shard, blocks = None, {}
    for batch in batches:
        out: list[dict] = []
        want: dict[int, list[dict]] = {}

        def meet() -> None:
            found: dict[tuple[int, int], list] = {}
            for b, anchors in want.items():
                ids, labels, vectors = blocks[b]
                products = scores(np.array([np.frombuffer(r["vector"]) for r in anchors]).reshape(len(anchors), vectors.shape[1]), vectors)
                for r, s in zip(anchors, products, strict=True):
                    if r["windows"] is None:
                        tops = {0: _tops(s, ids, (labels == r["label"]) & (ids != r["anchor_id"]), POSITIVES)}
                    else:
                        other = labels != r["label"]
                        tops = {w["window"]: _tops(s, ids, other & (s >= w["lowest"]) & (s <= w["highest"]), NEGATIVES)
                                for w in r["windows"]}
                    wanted = POSITIVES if r["windows"] is None else NEGATIVES
                    for w, top in tops.items():
                        key = (r["anchor"], w)
                        found[key] = _best(found.get(key, []) + top, wanted)
            for (anchor, w), top in found.items():
                out.extend({"anchor": anchor, "window": w, "id": i, "score": s} for s, i in top)
            want.clear()

        for r in batch.to_pylist():
            if r["shard"] != shard:
                meet()
                shard, blocks = r["shard"], {}
            if r["kind"] == 0:
                d = r["dim"]
                v = unpacked(r["width"], r["vectors"])
                blocks[r["block"]] = (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["row_labels"], np.int64), v.reshape(r["rows"], d))
            else:
                for b in r["blocks"]:
                    want.setdefault(b, []).append(r)
        meet()
        yield pa.RecordBatch.from_pylist(out, schema=arrow)


def read_blocks(plan: DataFrame, anchors: DataFrame, blocks: DataFrame, wanted: int) -> DataFrame:
    """(anchor, window, id, score, rank): the best ``wanted`` rows of each anchor and window."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = {"block": "int", "dim": "int", "rows": "int", "ids": "binary", "row_labels": "binary", "width": "int", "vectors": "binary"}
    own = {"anchor": "long", "anchor_id": "long", "label": "long", "vector": "binary", "blocks": "array<int>", "windows": WINDOWS}
    # Only blocks that some anchor needs are moved and multiplied.
    needed = plan.select("shard", F.explode("blocks").alias("block")).distinct()
    b = blocks.select("shard", *data).join(needed, ["shard", "block"], "left_semi")
    a = plan.join(anchors.drop("dim"), "anchor")
    both = b.select("shard", F.lit(0).alias("kind"), *data, *_nulls(**own)).unionByName(
        a.select("shard", F.lit(1).alias("kind"), *_nulls(**data), *own))
    scored = both.repartition(n, "shard").sortWithinPartitions("shard", "kind").mapInArrow(_read, SCORED)
    # The limit by rank is applied in each task before the shuffle.
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)


def mine(embeddings: DataFrame, block_bytes: int = BLOCK_BYTES, shard_blocks: int = SHARD_BLOCKS,
         zone_rows: int = ZONE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null vec_id or label, or a vector that is null or holds null or non-finite
    components, take no part. Vectors of different lengths have no score together; empty
    ones score 0. Repeated rows of a vec_id are rows of their own, but never a positive of
    an anchor of that vec_id, and each anchor row is answered. Ties go by vec_id. Scores
    beyond a long are its nearest end. Other columns are not read; an empty table (or one
    without anchors) gives no rows. Vectors of any length are read whole."""
    spark = embeddings.sparkSession
    base = scratch_path(spark, "negatives")
    rows = quantised(embeddings)
    write_blocks(rows, f"{base}/blocks", block_bytes, shard_blocks)
    blocks = spark.read.parquet(f"{base}/blocks")
    # Anchors get a number of their own, once and for all: rows may repeat a vec_id.
    (quantised(embeddings.where(F.col("vec_id") % ANCHOR_EVERY == 0))
     .select(F.monotonically_increasing_id().alias("anchor"), F.col("id").alias("anchor_id"), "dim", "label", "vector")
     .write.parquet(f"{base}/anchors"))
    anchors = spark.read.parquet(f"{base}/anchors")
    copies = anchors.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("copies"))
    anchors = anchors.join(copies, "anchor_id").select("*", *_nulls(windows=WINDOWS))
    read_blocks(plan_reads(anchors, blocks, zone_rows), anchors, blocks, POSITIVES) \
        .select("anchor", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")) \
        .write.parquet(f"{base}/positives")
    positives = spark.read.parquet(f"{base}/positives")
    lowest, highest = _window()
    open_ = positives.where("positive_score >= 0").groupBy("anchor").agg(F.collect_list(F.struct(
        F.col("window").cast("int").alias("window"), lowest.alias("lowest"), highest.alias("highest"))).alias("windows"))
    second = anchors.drop("windows").join(open_, "anchor")
    found = read_blocks(plan_reads(second, blocks, zone_rows), second, blocks, NEGATIVES) \
        .select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(positives, ["anchor", "window"]).join(anchors.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _window() -> tuple[Column, Column]:
    """Least and greatest integer score in the window of ``positive_score``, in long arithmetic."""
    q = F.expr(f"positive_score div {WHOLE}")
    return (q * LOW + F.expr(f"(positive_score % {WHOLE} * {LOW} + {WHOLE - 1}) div {WHOLE}"),
            q * HIGH + F.expr(f"(positive_score % {WHOLE} * {HIGH}) div {WHOLE}"))
