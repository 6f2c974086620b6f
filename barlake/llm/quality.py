"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes (learned tables, one row per byte value) run over the
whole text every ``STRIDE`` bytes. Their rectified responses are averaged over
chunks of two blocks; chunks overlap by one block. A hidden layer reads each
chunk, the strongest response of each hidden unit over all chunks is kept, and a
logistic unit combines these into one probability. Only bytes are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from barlake.llm.common import temp_name

WIDTH, STRIDE, BLOCK = 4, 2, 32
FILTERS, HIDDEN = 16, 32
#: A longer text is read in segments of this many blocks that share one block.
SEGMENT_BLOCKS = 8192
#: Bounds of the training sample: labelled rows (smallest hashes of doc_id), and bytes of
#: all of them together. Texts are taken whole, whatever their length; the one that
#: uses up the bytes is the last.
TRAIN_DOCS, TRAIN_BYTES = 2_000, 16_000_000
STEPS, BATCH, RATE, SEED = 1_250, 16, 0.01, 7
THRESHOLD = 0.3
SLICE_BYTES = 250_000


@dataclass
class Model:
    """Weights, or only a rate where the labelled rows held no two classes."""
    weights: dict[str, np.ndarray] | None
    rate: float


def _layout(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of padded bytes and the text that each belongs to, about
    ``SLICE_BYTES`` at once. A text has two blocks at least and ends in padding."""
    rows: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    held = 0
    for i, t in enumerate(texts):
        data = np.frombuffer(t, dtype=np.uint8)
        n = max(2, -(-(len(data) + WIDTH) // BLOCK))
        for first in range(0, n - 1, SEGMENT_BLOCKS):
            last = min(n, first + SEGMENT_BLOCKS + 1)
            part = np.zeros((last - first) * BLOCK, dtype=np.uint8)
            own = data[first * BLOCK:last * BLOCK]
            part[:len(own)] = own
            rows.append(part)
            owner.append(np.full(last - first, i))
            held += len(part)
            if held >= SLICE_BYTES:
                yield np.concatenate(rows), np.concatenate(owner)
                rows, owner, held = [], [], 0
            # a segment's last block is the next one's first, so chunks are unbroken
    if rows:
        yield np.concatenate(rows), np.concatenate(owner)


def _chunks(data: np.ndarray, owner: np.ndarray, w: dict[str, np.ndarray]):
    """Rectified filter responses by block, chunk averages, and chunk owners."""
    padded = np.concatenate([data, np.zeros(WIDTH, dtype=np.uint8)])
    n = len(data) // STRIDE
    taken = [padded[j:j + len(data):STRIDE] for j in range(WIDTH)]
    out = w["bias"] + np.take(w["table"][0], taken[0], axis=0)
    for j in range(1, WIDTH):
        out += np.take(w["table"][j], taken[j], axis=0)
    np.maximum(out, 0, out=out)
    per = BLOCK // STRIDE
    blocks = out.reshape(n // per, per, FILTERS).sum(axis=1)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    return out, taken, pair, (blocks[pair] + blocks[pair + 1]) / (2 * per)


def _pooled(texts: list[bytes], w: dict[str, np.ndarray]) -> np.ndarray:
    """Strongest hidden responses of each text."""
    best = np.zeros((len(texts), HIDDEN), dtype=np.float32)
    for data, owner in _layout(texts):
        _, _, pair, chunk = _chunks(data, owner, w)
        hidden = np.maximum(chunk @ w["hidden"] + w["hidden_bias"], 0)
        of = owner[pair]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        np.maximum.at(best, of[starts], np.maximum.reduceat(hidden, starts, axis=0))
    return best


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Probability of good quality of each UTF-8 text (empty texts too)."""
    if not texts:
        return np.zeros(0)
    if model.weights is None:
        return np.full(len(texts), model.rate)
    w = model.weights
    z = _pooled(texts, w).astype(np.float64) @ w["out"] + w["out_bias"][0]
    return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)


def fit(texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = SEED) -> Model:
    """Learn all weights by Adam on the log loss, about ``steps`` steps of ``BATCH``
    texts whatever the number of rows."""
    y = np.array(labels, dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return Model(None, float((y.sum() + 1) / (len(y) + 1)) if len(y) else 1.0)
    rng = np.random.default_rng(seed)
    w = {"table": rng.normal(0, 0.5, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS),
         "hidden": rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)), "hidden_bias": np.zeros(HIDDEN),
         "out": rng.normal(0, 0.3, HIDDEN), "out_bias": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    per, step = BLOCK // STRIDE, 0
    epochs = max(1, round(steps * BATCH / len(texts)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            ids = order[at:at + BATCH]
            parts = list(_layout([texts[i] for i in ids]))
            data, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            out, taken, pair, chunk = _chunks(data, owner, w)
            hidden = np.maximum(chunk @ w["hidden"] + w["hidden_bias"], 0)
            of = owner[pair]
            # The chunk in which each unit of each text is strongest.
            top = np.stack([np.flatnonzero(of == d)[0] + hidden[of == d].argmax(axis=0) for d in range(len(ids))])
            pooled = np.take_along_axis(hidden, top, axis=0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ w["out"] + w["out_bias"][0], -30, 30)))
            dz = ((p - y[ids]) / len(ids)).astype(np.float32)
            g = {"out": pooled.T @ dz, "out_bias": np.array([dz.sum()])}
            dpool = dz[:, None] * w["out"] * (pooled > 0)
            dhidden = np.zeros_like(hidden)
            np.add.at(dhidden, (top, np.arange(HIDDEN)), dpool)
            g["hidden"], g["hidden_bias"] = chunk.T @ dhidden, dhidden.sum(axis=0)
            dchunk = dhidden @ w["hidden"].T / (2 * per)
            dblock = np.zeros((len(owner), FILTERS), dtype=np.float32)
            np.add.at(dblock, pair, dchunk)
            np.add.at(dblock, pair + 1, dchunk)
            hot = np.flatnonzero(np.abs(dblock).sum(axis=1) > 0)  # few blocks hold a strongest chunk
            rows = (hot[:, None] * per + np.arange(per)).ravel()
            dout = np.repeat(dblock[hot], per, axis=0) * (out[rows] > 0)
            g["bias"] = dout.sum(axis=0)
            g["table"] = np.zeros_like(w["table"])
            for j in range(WIDTH):
                np.add.at(g["table"][j], taken[j][rows], dout)
            step += 1
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** step))
                        / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(w, float(y.mean()))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Rows that no label is learned from."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("long").cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Fit on at most ``train_docs`` labelled rows that are not held out, drawn by the hash
    of their id until their whole texts hold ``train_bytes`` bytes (this bounds what
    reaches the driver). Rows without id, text or label do not count; of contradicting
    labels the majority does; equal rows are one."""
    truth = (labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("double").alias("label"))
             .filter("doc IS NOT NULL AND label IS NOT NULL").filter(~held_out("doc"))
             .groupBy("doc").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc"), "doc").limit(train_docs))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("digest", F.xxhash64("text"))
    # Lengths first: no more text than the bytes allow leaves its task.
    drawn = (texts.filter("text IS NOT NULL").join(F.broadcast(truth), "doc")  # at most train_docs rows
             .select("doc", "digest", "label", F.octet_length("text").alias("bytes")).distinct()
             .orderBy(F.xxhash64("doc"), "doc", "digest").limit(train_docs).collect())
    held = np.cumsum([0, *[r["bytes"] for r in drawn]])
    chosen = {(r["doc"], r["digest"]): r["label"] for r, before in zip(drawn, held, strict=False) if before < train_bytes}
    if not chosen:
        return fit([], [])
    wanted = docs.sparkSession.createDataFrame(list(chosen), "doc long, digest long")
    found = texts.join(F.broadcast(wanted), ["doc", "digest"]).dropDuplicates(["doc", "digest"]).collect()
    by_key = {(r["doc"], r["digest"]): r["text"].encode() for r in found}
    return fit([by_key[k] for k in chosen], list(chosen.values()))


def score_column(model: Model):
    """Column function: score of a text column (null as empty), in bounded slices."""
    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            parts, block, held = [np.zeros(0)], [], 0
            for text in series:
                block.append(text.encode())
                held += len(block[-1])
                if held >= SLICE_BYTES:
                    parts.append(scores(block, model))
                    block, held = [], 0
            parts.append(scores(block, model))
            yield pd.Series(np.concatenate(parts), dtype="float64")

    def of(text: Column) -> Column:
        return score(F.coalesce(text.cast("string"), F.lit("")))
    return of


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, held_out boolean, score double, predicted int), a row per row.

    Null and empty texts are scored as padding only. A null doc_id is not held
    out. Repeated rows stay, extra columns are not carried, an empty table gives
    an empty result. Very long texts are read whole, in segments.
    """
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         score_column(model)(F.col(text_col)).alias("score"))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``; all columns stay."""
    score = temp_name(docs, "score")
    return docs.withColumn(score, score_column(model)(F.col(text_col))).filter(F.col(score) >= threshold).drop(score)


def model_for(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    """The model of ``docs`` and the labels table of ``sf_dir``."""
    return train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
