"""Line dedup with DataFrame functions only: levelled sorted runs of line hashes.

Every line of a text has a key (white space at both ends stripped, A-Z lowered)
and the key a 128-bit hash. Documents arrive in batches. The entries seen so far,
(hash, first document), lie in Parquet runs, each sorted by hash. A batch reduces
its lines to one entry per hash, merge-anti-joins them against the runs, and adds
those not met as a new run of level 0. Once a level has ``FANOUT`` runs they are
merged into one run of the next level, so n batches leave about log(n) runs to
read and each entry is rewritten about log(n) times.

A line is dropped from every document but the one that its entry names. Batches in
ascending order of doc_id therefore keep a line in the smallest doc_id; batches that
come in any other order keep it where it was seen first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import temp_name
from barlake.session import scratch_path

# White space at the ends of a line, and the letters that are lowered.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points that a key needs before its lines can be dropped.
MIN_KEY = 10
#: Runs of one level that are merged into one of the next.
FANOUT = 2
#: Batches in which ``dedupe`` feeds a whole table.
BATCHES = 4
#: A null doc_id counts as this one, the largest.
LAST = 2**63 - 1
HASH = ["h1", "h2"]


def key_of(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t, text): the id that orders documents and a hash that tells texts of one id apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("d"), text.alias("text")) \
        .withColumn("t", F.xxhash64("text"))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, t, pos, h1, h2): the hashes of every line whose key is long enough."""
    lines = _rows(docs, id_col, text_col).select("d", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("d", "t", "pos", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= MIN_KEY)
    return keys.select("d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


@dataclass(frozen=True)
class Run:
    level: int
    path: str


class LineRuns:
    """The runs of all batches so far, in a folder that all executors share.

    ``add`` may be repeated with the same batch (a job that died half-way): entries
    that the batch itself wrote name its own documents, so the answer is the same."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root or scratch_path(spark, "line-runs"), fanout
        self.runs: list[Run] = []
        self._written = 0

    def entries(self) -> DataFrame:
        """(h1, h2, first): one row per hash seen so far."""
        schema = "h1 long, h2 long, first long"
        if not self.runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[r.path for r in self.runs])

    def _write(self, entries: DataFrame, level: int) -> None:
        self._written += 1
        path = f"{self.root}/level={level}-run={self._written}"
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        entries.repartitionByRange(n, *HASH).sortWithinPartitions(*HASH).write.mode("overwrite").parquet(path)
        self.runs.append(Run(level, path))

    def _compact(self) -> None:
        """Merge the runs of each full level into one of the next (no hash is in two runs)."""
        level = 0
        while level <= max((r.level for r in self.runs), default=-1):
            full = [r for r in self.runs if r.level == level]
            if len(full) >= self.fanout:
                merged = self.spark.read.parquet(*[r.path for r in full])
                self.runs = [r for r in self.runs if r.level != level]
                self._write(merged, level + 1)
            level += 1

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Take in a batch; returns (d, t, cuts): the positions of the lines that go, in
        order, for each document that loses any."""
        spark = self.spark
        path = scratch_path(spark, "lines")
        line_hashes(docs, id_col, text_col).write.parquet(path)
        lines = spark.read.parquet(path)
        own = lines.groupBy(*HASH).agg(F.min("d").alias("own"), F.max("d").alias("last"))
        path = scratch_path(spark, "line-entries")
        # The left join answers the anti-join (seen is null) and finds the first document in one merge.
        own.join(self.entries().withColumnRenamed("first", "seen").hint("merge"), HASH, "left").write.parquet(path)
        met = spark.read.parquet(path)
        fresh = F.col("seen").isNull()
        self._write(met.where(fresh).select(*HASH, F.col("own").alias("first")), 0)
        self._compact()
        shared = met.where(~fresh | (F.col("last") > F.col("own"))).select(*HASH, F.coalesce("seen", "own").alias("first"))
        gone = lines.join(shared, HASH).where(F.col("d") != F.col("first"))
        return gone.groupBy("d", "t").agg(F.array_sort(F.collect_set("pos")).alias("cuts"))


def kept_lines(lines: Column, cuts: Column) -> Column:
    """``lines`` without those at the positions ``cuts`` (ascending): the stretches between them."""
    def stretches(x: Column) -> Column:
        def stretch(i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(x["cuts"], i - 1) + 1)
            end = F.coalesce(F.get(x["cuts"], i), F.size(x["lines"]))
            return F.slice(x["lines"], start + 1, end - start)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["cuts"])), stretch))
    return F.element_at(F.transform(F.array(F.struct(lines.alias("lines"), cuts.alias("cuts"))), stretches), 1)


def _without(docs: DataFrame, cuts: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its lines and cuts in new columns, and the names of these."""
    names = {n: temp_name(docs, f"line_{n}") for n in ("d", "t", "all", "cuts")}
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.withColumns({names["d"]: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)), names["t"]: F.xxhash64(text)})
    own = cuts.select(F.col("d").alias(names["d"]), F.col("t").alias(names["t"]), F.col("cuts").alias(names["cuts"]))
    joined = rows.join(own, [names["d"], names["t"]], "left")
    return joined.withColumn(names["all"], F.split(text, "\n", -1)), names


def cuts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
            runs: LineRuns | None = None) -> DataFrame:
    """(d, t, cuts) of a whole table, fed in ``batches`` ranges of ascending doc_id."""
    spark = docs.sparkSession
    runs = runs or LineRuns(spark)
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(order, F.array(*map(F.lit, shares)), 10_000).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(found or []))  # a table of few ids has fewer batches
    cuts = None
    for lo, hi in zip([None, *bounds], [*bounds, None], strict=True):
        inside = (F.lit(True) if lo is None else order > lo) & (F.lit(True) if hi is None else order <= hi)
        batch = runs.add(docs.where(inside), id_col, text_col)
        cuts = batch if cuts is None else cuts.unionByName(batch)
    return cuts


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): one row per input row.

    Keys of at least ``MIN_KEY`` code points that two or more doc_ids hold lose all
    their lines except in the smallest doc_id that holds them (there all copies stay).
    A null or empty text is one empty line. Rows that repeat a doc_id are one document:
    they do not make a line shared, and each row is answered. Null ids are one document
    after all others, and stay null. A text of any length is split inside its row; what
    is gathered per document are positions of its own dropped lines. Extra columns are
    not carried; an empty table gives none."""
    rows, names = _without(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                       F.col(f"`{text_col}`").cast("string").alias("text")),
                           cuts_of(docs, id_col, text_col, batches), "doc_id", "text")
    lines, cuts = F.col(names["all"]), F.col(names["cuts"])
    return rows.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                       F.coalesce(F.size(cuts), F.lit(0)).cast("long").alias("n_dropped"),
                       F.when(cuts.isNull(), F.coalesce("text", F.lit("")))
                       .otherwise(F.array_join(kept_lines(lines, cuts), "\n")).alias("kept"))


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``docs`` with the repeated lines gone from its texts: all rows, columns and their
    order stay; a null text stays null."""
    rows, names = _without(docs, cuts_of(docs, id_col, text_col, batches), id_col, text_col)
    lines, cuts = F.col(names["all"]), F.col(names["cuts"])
    text = F.when(cuts.isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept_lines(lines, cuts), "\n"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
