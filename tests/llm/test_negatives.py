"""Hard-negative mining against a scan of all rows; the curve; bounds; odd rows."""

import math
import random

import numpy as np
import pytest

from barlake.llm import negatives as N

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    """Results of (vec_id, vector, label) rows by looking at every pair."""
    own = []
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        own.append((i, [math.floor(x * 256) for x in vec], int(math.fmod(label + 1, 10)) if i % 7 == 0 else label))
    out = []
    for i, vec, label in own:
        if i % 100:
            continue
        scored = [(-max(-N.LONG_MAX, min(N.LONG_MAX, sum(a * b for a, b in zip(vec, v, strict=True)))), j, k)
                  for j, v, k in own if len(v) == len(vec)]
        for s, j, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:5]:
            fit = sorted(x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(i, j, n + 1, m, -s, -t) for n, (t, m, _) in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_all_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    assert want
    assert found(N.mine(df, block_bytes=64 * 8 * 16, shard_blocks=2, zone_rows=8)) == want


def odd_rows():
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) + (i % 4 == d) * 3 for d in range(4)], rnd.randint(0, 3)) for i in range(-200, 400)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0], 1) for i in range(1_000, 1_300)]  # ties
    rows += [(i, [1.0, 1.0, 1.0, 1.0], 2) for i in range(2_000, 2_200)] + [(100, [1.0, 2.0, 3.0, 4.0], 1)] * 7  # repeated rows
    rows += [(i, [0.5] * 4, 2) for i in (0, 0)] + [(3_000, [], 1), (3_001, [], 1), (3_002, [], 2), (None, [1.0] * 4, 1)]
    rows += [(4_000, [1.0, 1.0], 5), (4_001, [1.0, 2.0], 5), (4_003, [1.0, 0.7], 6), (4_004, [0.5, 0.5], 6)]
    rows += [(5_000, None, 1), (5_100, [1.0] * 4, None), (5_200, [1.0, None, 1.0, 1.0], 1), (5_300, [float("nan")] * 4, 1),
             (5_400, [float("inf")] * 4, 1), (5_500, [0.0] * 4, 3), (5_501, [-0.0] * 4, 3)]
    return rows + [(6_000, [3e13, 1.0, -2e13], 1), (6_001, [3e13, 2.0, 1.0], 1), (6_002, [2e13, 1e12, -1.0], 2),
                   (6_100, [1e300, 1.0, 1.0], 1), (6_101, [1.0, 1e16, 0.0], 1)]


def test_odd_rows(spark):
    rows = odd_rows()
    want = plain(rows)
    df = spark.createDataFrame([(*r, 0, 0.5, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, id int, score double, anchor string")
    assert found(N.mine(df)) == want
    assert found(N.mine(df, block_bytes=256, shard_blocks=3, zone_rows=10)) == want
    assert N.mine(df.limit(0)).collect() == []
    assert N.mine(df.where("vec_id = 1")).collect() == []


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 3), (3, 2), (4, 2), (5, 1)])
def test_curve_visits_neighbours(dims, bits):
    """Every cell once, and each step to a cell that shares a face."""
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = [bytes(k) for k in N.hilbert(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array(keys, dtype=object), kind="stable")]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_choose(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 200, (12, 8))
    rows = np.floor(centres[np.repeat(np.arange(12), 40)] + rng.normal(0, 5, (480, 8)))
    anchors = rows[::37]
    lo, hi = rows.reshape(12, 40, 8).min(1), rows.reshape(12, 40, 8).max(1)
    least, most = N.bounds(anchors, lo, hi)
    s = N.scores(anchors, rows).reshape(len(anchors), 12, 40)
    assert (s >= least[:, :, None]).all() and (s <= most[:, :, None]).all()
    zones = {"rows": np.full(12, 40), "lo": lo, "hi": hi, "by_label": {1: np.full(12, 20), 2: np.full(12, 20)}}
    need = N._wanted_blocks(anchors, [1] * len(anchors), np.ones(len(anchors), np.int64), None, zones)
    assert need.any(axis=1).all() and need.mean() < 0.5  # clustered rows: most blocks are not read


def test_query_matches_sql(spark):
    import duckdb

    from barlake.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(ORACLE["op11_negatives"])
    names = [c[0] for c in con.description]
    assert sorted(map(tuple, QUERIES["op11_negatives"](spark, sf).select(*names).collect())) == sorted(want.fetchall())
