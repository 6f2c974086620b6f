"""Shared helpers: table readers, bounded Arrow batches, lineage cuts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.session import pin

#: Text handled at once in a Python worker; a batch is cut into slices of this
#: size, so memory does not follow the Arrow batch (a longer text is one slice).
SLICE_CHARS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), null texts as empty; other columns go, so
    that no extra column can clash with an operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str,
           max_chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Sub-batches whose texts hold at most ``max_chars`` bytes (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.binary_length(col.cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_texts(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, Any]]],
              schema: str, column: str = "text", binary: bool = False,
              max_chars: int = SLICE_CHARS) -> DataFrame:
    """Apply ``make()(columns)`` to bounded slices of rows inside tasks.

    ``columns`` maps names to Python lists (the text as bytes when ``binary``);
    the function returns the output columns as lists, numpy or Arrow arrays.
    """
    out = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for part in slices(batches, column, max_chars):
            cols = {}
            for name, col in zip(part.schema.names, part.columns, strict=True):
                cols[name] = (col.cast(pa.binary()) if binary and name == column else col).to_pylist()
            got = fn(cols)
            yield pa.RecordBatch.from_arrays(
                [got[f.name].cast(f.type) if isinstance(got[f.name], pa.Array) else pa.array(got[f.name], type=f.type)
                 for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...],
                  rows: int = 10_000) -> Iterator[dict[str, np.ndarray]]:
    """Columns of consecutive rows, cut only between keys: rows arrive sorted by
    ``keys``; each block holds whole groups, at least ``rows`` rows but for the last
    (more only as far as one group or one Arrow batch reaches). No block is empty."""
    pending: list[dict[str, np.ndarray]] = []
    held = 0

    def joined() -> dict[str, np.ndarray]:
        return {k: np.concatenate([p[k] for p in pending]) for k in pending[0]}

    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        if held >= rows:
            change = np.zeros(batch.num_rows, dtype=bool)  # a new key begins here
            for k in keys:
                change[0] |= cols[k][0] != pending[-1][k][-1]
                change[1:] |= cols[k][1:] != cols[k][:-1]
            first = np.flatnonzero(change)
            if len(first):
                pending.append({k: v[:first[0]] for k, v in cols.items()})
                yield joined()
                cols = {k: v[first[0]:] for k, v in cols.items()}
                pending, held = [], 0
        pending.append(cols)
        held += len(cols[keys[0]])
    if pending:
        yield joined()


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others for 256 and up, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder."""
    return pin(df)


def temp_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (also not in other letter case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name
