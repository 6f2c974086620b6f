"""Line dedup against plain code; levels of runs; odd rows."""

import hashlib

from pyspark.sql import functions as F

from barlake.llm import linededup as L

CLASHING = "doc_id long, text string, d long, t long, cuts string, line_d int, line_all int, h1 int"


def plain(rows, smallest=True):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows, by dictionaries."""
    lower = str.maketrans(L.UPPER, L.LOWER)
    owner, holders = {}, {}
    for i, text in rows:
        i = L.LAST if i is None else i
        for line in (text or "").split("\n"):
            key = line.strip(L.BLANKS).translate(lower)
            owner[key] = min(i, owner.get(key, i))
            holders.setdefault(key, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            key = line.strip(L.BLANKS).translate(lower)
            if len(key) < L.MIN_KEY or len(holders[key]) < 2 or owner[key] == (L.LAST if i is None else i):
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_equals_plain_code_on_all_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows)
    assert any(r[2] for r in want)
    for batches in (1, 4):
        assert found(L.scan(docs, batches=batches)) == want


LINE, OTHER = "a common line of text", "another common line"
ODD = [(1, None), (2, ""), (3, f"  {LINE.upper()}\t\nshort\n{LINE}"), (4, f"{LINE}\n{LINE}\nown line of four"),
       (5, OTHER), (5, OTHER), (5, f"{OTHER}\n{LINE}"), (None, LINE), (None, f"{OTHER}\nshort"), (7, "\n\n"),
       (8, "ÉCOLE commune ici\nécole commune ici"), (9, "École commune ici\nÉcole COMMUNE ici "), (10, "short"),
       (11, "x" * 10), (12, "x" * 10), (13, "x" * 9), (14, "x" * 9), (15, f"{LINE}\n" * 20_000 + "end of the long text"),
       (-1, "end of the LONG text"), (16, "🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"), (17, " 🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂")]


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 0, 0, "c", 0, 0, 0) for i, t in ODD], CLASHING)
    for batches in (1, 7):
        assert found(L.scan(df, batches=batches)) == plain(ODD)
    kept = L.drop_repeated(df)
    assert kept.columns == df.columns and kept.count() == len(ODD)
    want = {(i, k) for i, _, _, k in plain(ODD)}
    assert {(r["doc_id"], r["text"] or "") for r in kept.collect()} == want
    assert kept.where("text is null").count() == 1
    assert L.scan(df.limit(0)).collect() == []


def test_runs_are_sorted_levelled_and_disjoint(spark, docs):
    runs = L.LineRuns(spark)
    levels = []
    for b in range(5):
        runs.add(docs.where(F.col("doc_id") % 5 == b)).collect()
        levels.append(sorted(r.level for r in runs.runs))
    assert levels == [[0], [1], [0, 1], [2], [0, 2]]
    entries = runs.entries()
    assert entries.count() == entries.select(*L.HASH).distinct().count() == L.line_hashes(docs).select(*L.HASH).distinct().count()
    for run in runs.runs:
        parts = spark.read.parquet(run.path).withColumn("f", F.col("_metadata.file_name")) \
            .groupBy("f").agg(F.collect_list(F.struct(*L.HASH)).alias("h"), F.array_sort(F.collect_list(F.struct(*L.HASH))).alias("s"))
        assert parts.where("h != s").count() == 0
    # A batch that is added again (a job that died half-way) gives the same answer.
    again = docs.where(F.col("doc_id") % 5 == 4)
    assert sorted(map(str, runs.add(again).collect())) == sorted(map(str, runs.add(again).collect()))


def test_kept_lines(spark):
    lines = F.array(*[F.lit(x) for x in "abcde"])
    for cuts in ([], [0], [4], [0, 1, 2, 3, 4], [1, 3], [0, 4]):
        col = F.array(*[F.lit(c) for c in cuts]).cast("array<int>")
        got = spark.range(1).select(L.kept_lines(lines, col).alias("k")).first()["k"]
        assert got == [x for i, x in enumerate("abcde") if i not in cuts]


def test_query_matches_sql(spark):
    import duckdb

    from barlake.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(ORACLE["op12_linededup"]).fetchall()
    got = QUERIES["op12_linededup"](spark, sf)
    names = [c[0] for c in con.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest()
               for r in L.scan(spark.read.parquet(f"{sf}/documents.parquet"))
               .withColumn("kept_sha256", F.sha2("kept", 256)).collect())
