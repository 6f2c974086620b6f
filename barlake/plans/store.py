"""The bar lake on Parquet: layout, merge of increments, state tables and
storage inventory (SRC-3..9, SRC-13, SO-1, AG-1, AG-2).

Layout: ``{root}/bars/asset_class=/timeframe=/year=/part-*.parquet`` holding
the ten canonical columns; rows are range-partitioned and sorted by
(symbol, timestamp) inside each year, so Parquet row-group statistics on
``symbol`` prune like a folder per symbol would, without tiny files.

Side tables are versioned snapshots: ``{root}/manifest/version=N``,
``{root}/universe/version=N`` and ``{root}/findings/version=N``. A writer adds
version N+1 in its own folder; a reader takes the newest folder that carries
the commit marker, so an empty version is still the newest and a crashed write
is never seen. Version numbers are compared as numbers and never reused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.profiles import PROFILES
from barlake.operators import state as S
from barlake.operators import validation as V
from barlake.operators.dedupe import KEEP_FIRST
from barlake.schemas import BAR_COLUMNS, BARS, LAKE_PARTITIONS, MANIFEST, SERIES_YEARS
from barlake.session import pin

LAKE_SCHEMA = T.StructType(BARS.fields + [
    T.StructField("asset_class", T.StringType(), True),
    T.StructField("timeframe", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
])
LAKE_KEY = ["asset_class", "timeframe", "symbol", "timestamp"]
# Target rows per output file of a rewritten partition.
ROWS_PER_FILE = 2_000_000


def bars_path(root: str) -> str:
    return f"{root.rstrip('/')}/bars"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def list_tables(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(asset_class, timeframe) tables of the lake, from the folder names only."""
    if not path_exists(spark, bars_path(root)):
        return []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{bars_path(root)}/asset_class=*/timeframe=*")
    found = pattern.getFileSystem(conf).globStatus(pattern) or []
    out = []
    for st in found:
        if st.isDirectory():
            tf = st.getPath().getName().split("=", 1)[1]
            ac = st.getPath().getParent().getName().split("=", 1)[1]
            out.append((ac, tf))
    return sorted(out)


def with_layout(bars: DataFrame, asset_class: str | None = None, timeframe: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Canonical bars plus the lake's partition columns (asset_class and
    timeframe from the arguments, or already on the rows), and the columns ``keep``."""
    df = bars
    if asset_class is not None:
        df = df.withColumn("asset_class", F.lit(asset_class))
    if timeframe is not None:
        df = df.withColumn("timeframe", F.lit(timeframe))
    return df.withColumn("year", F.year("timestamp")).select(*BAR_COLUMNS, *LAKE_PARTITIONS, *keep)


def write_bars(bars: DataFrame, root: str, *, num_files: int | None = None,
               tables: Sequence[tuple[str, str]] | None = None, mode: str = "overwrite") -> None:
    """Write lake rows (canonical + partition columns). ``overwrite``
    replaces only the year partitions present in ``bars`` (dynamic partition
    overwrite); ``append`` adds files next to the stored ones.

    Each (asset_class, timeframe) table is written to its own folder with
    ``year`` as the only partition column. Rows are range-partitioned and
    sorted by (year, symbol, timestamp), which is also the ordering the file
    writer requires, so the sort survives into the files (a literal partition
    column would be folded out of the sort and the writer would re-sort)."""
    spark = bars.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tables is None:
        tables = [(r["asset_class"], r["timeframe"])
                  for r in bars.select("asset_class", "timeframe").distinct().collect()]
    order = ["year", "symbol", "timestamp"]
    for asset_class, timeframe in tables:
        part = bars.where((F.col("asset_class") == asset_class) & (F.col("timeframe") == timeframe)) \
            .drop("asset_class", "timeframe")
        out = part.repartitionByRange(n, *order).sortWithinPartitions(*order)
        (out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .partitionBy("year")
            .parquet(f"{bars_path(root)}/asset_class={asset_class}/timeframe={timeframe}"))


def read_bars(spark: SparkSession, root: str, *, asset_class: str | None = None,
              timeframe: str | None = None, years: Sequence[int] | None = None,
              with_partitions: bool = False) -> DataFrame:
    """Scan the lake; partition predicates prune folders, others push down."""
    if not path_exists(spark, bars_path(root)):
        empty = spark.createDataFrame([], LAKE_SCHEMA).limit(0)  # so that the planner knows, too
        return empty if with_partitions else empty.select(*BAR_COLUMNS)
    df = spark.read.schema(LAKE_SCHEMA).parquet(bars_path(root))
    if asset_class is not None:
        df = df.where(F.col("asset_class") == asset_class)
    if timeframe is not None:
        df = df.where(F.col("timeframe") == timeframe)
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    return df if with_partitions else df.select(*BAR_COLUMNS)


def read_window(spark: SparkSession, root: str, asset_class: str, timeframe: str, from_date: str,
                to_date: str) -> DataFrame:
    """PRJ-12 on the lake: bars with date in [from, to] (inclusive). The year
    predicate prunes folders, the timestamp predicate pushes down to row groups."""
    y0, y1 = int(from_date[:4]), int(to_date[:4])
    df = read_bars(spark, root, asset_class=asset_class, timeframe=timeframe, years=range(y0, y1 + 1))
    lo = F.lit(from_date).cast("timestamp")
    hi = F.date_add(F.lit(to_date).cast("date"), 1).cast("timestamp")
    return df.where((F.col("timestamp") >= lo) & (F.col("timestamp") < hi))


def drop_partition(spark: SparkSession, root: str, asset_class: str, timeframe: str, year: int) -> bool:
    """SRC-9 delete: remove one year folder of one table."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(
        f"{bars_path(root)}/asset_class={asset_class}/timeframe={timeframe}/year={int(year)}")
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p) and fs.delete(p, True))


def touched_partitions(new: DataFrame) -> list[tuple[str, str, int]]:
    """Distinct (asset_class, timeframe, year) of a batch: a handful of rows."""
    rows = new.select(*LAKE_PARTITIONS).distinct().collect()
    return [(r["asset_class"], r["timeframe"], r["year"]) for r in rows]


@dataclass(frozen=True)
class Merged:
    """What a merge did: partitions of the batch, and bars that were new."""
    partitions: list[tuple[str, str, int]]
    bars: int

    @property
    def years(self) -> list[int]:
        return sorted({y for _, _, y in self.partitions})


def merge_into_lake(new: DataFrame, root: str, *, new_order: Sequence[str] = (),
                    policy: str = KEEP_FIRST) -> Merged:
    """SRC-6: merge-append a batch of lake rows; stored rows are never replaced.

    The new rows are de-duplicated (``policy``) and anti-joined against the stored
    keys of the touched year partitions only; the fresh rows are then *appended* as
    new files (range-partitioned and sorted by symbol and time), so an increment
    never rewrites the years it touches. ``compact`` rewrites partitions into
    few large sorted files when wanted. Rerunning a batch appends nothing, as
    every key then collides."""
    spark = new.sparkSession
    parts = touched_partitions(new)
    if not parts:
        return Merged([], 0)
    stored = read_bars(spark, root, with_partitions=True)
    cond = None
    for a, t, y in parts:
        c = (F.col("asset_class") == a) & (F.col("timeframe") == t) & (F.col("year") == y)
        cond = c if cond is None else (cond | c)
    cols = [*BAR_COLUMNS, *LAKE_PARTITIONS]
    extra = [c for c in new_order if c not in cols]
    fresh = pin(S.fresh_rows(stored.where(cond).select(*cols), new.select(*cols, *extra), LAKE_KEY, new_order, policy=policy))
    n = fresh.count()
    if n:
        n_files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_FILE)))
        write_bars(fresh, root, num_files=n_files, tables=sorted({(a, t) for a, t, _ in parts}), mode="append")
    return Merged(parts, n)


def compact(spark: SparkSession, root: str, asset_class: str, timeframe: str,
            years: Sequence[int] | None = None) -> None:
    """SRC-13: rewrite year partitions of one table into range-partitioned,
    sorted files (dynamic overwrite of those years only)."""
    df = read_bars(spark, root, asset_class=asset_class, timeframe=timeframe, years=years, with_partitions=True)
    # The rewrite reads the partitions it replaces: pin the rows first.
    rows = pin(df)
    n_files = max(1, -(-rows.count() // ROWS_PER_FILE))
    write_bars(rows, root, num_files=n_files, tables=[(asset_class, timeframe)])


def storage_usage(spark: SparkSession, root: str) -> DataFrame:
    """SRC-9: files and bytes per partition, from the file listing only (no file is
    opened); no rows where the lake holds no bars."""
    if not path_exists(spark, bars_path(root)):
        return spark.createDataFrame([], "asset_class string, timeframe string, year int, files bigint, bytes bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(bars_path(root))
    return files.groupBy("asset_class", "timeframe", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def schema_drift(spark: SparkSession, root: str) -> DataFrame:
    """V-1: lake files whose footer differs from the bar schema (``validation.footer_drift``),
    with the table and year of each."""
    if not path_exists(spark, bars_path(root)):
        return V.footer_drift(spark.createDataFrame([], "path string"), {})
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(bars_path(root)) \
        .select("path", "asset_class", "timeframe", F.col("year").cast("int").alias("year"))
    found = V.footer_drift(files, {f.name: f.dataType.simpleString() for f in BARS.fields})
    return found.join(files, found["file"] == files["path"]).drop("path")


# ------------------------------------------------------ versioned tables --

def _version_dirs(spark: SparkSession, path: str, committed_only: bool = True) -> list[tuple[int, object]]:
    """(version, Hadoop path) of the ``version=N`` folders; committed ones carry
    the writer's ``_SUCCESS`` marker (a crashed write leaves none)."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/version=*")
    fs = pattern.getFileSystem(conf)
    out = []
    for st in fs.globStatus(pattern) or []:
        name = st.getPath().getName().split("=", 1)[1]
        if not st.isDirectory() or not name.isdigit():
            continue
        if committed_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue
        out.append((int(name), st.getPath()))
    return sorted(out, key=lambda v: v[0])


def read_latest(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The newest committed version of table ``name`` (an empty version is a
    valid newest version)."""
    path = table_path(root, name)
    versions = _version_dirs(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1][0]}")


def write_version(df: DataFrame, root: str, name: str) -> int:
    """Write ``df`` as the next version of table ``name``; returns the version.
    Numbers are never reused, not even those of crashed writes."""
    spark = df.sparkSession
    path = table_path(root, name)
    existing = _version_dirs(spark, path, committed_only=False)
    version = (existing[-1][0] if existing else 0) + 1
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")
    return version


def prune_versions(spark: SparkSession, root: str, name: str, keep: int = 7) -> int:
    """Delete all but the newest ``keep`` committed versions of table ``name``
    (and any crashed write older than those). Returns the number removed."""
    path = table_path(root, name)
    committed = _version_dirs(spark, path)
    if keep < 1 or len(committed) <= keep:
        return 0
    oldest_kept = committed[-keep][0]
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for v, p in _version_dirs(spark, path, committed_only=False):
        if v < oldest_kept:
            fs.delete(p, True)
            removed += v in {c for c, _ in committed}
    return removed


def read_appended(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """All rows of the append-only table ``name`` (none where it was never written)."""
    path = table_path(root, name)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, "manifest", MANIFEST)


def get_state(spark: SparkSession, root: str, asset_class: str, symbol: str, timeframe: str):
    """JN-3: the manifest row of one series, or None."""
    m = read_manifest(spark, root).where((F.col("asset_class") == asset_class) & (F.col("symbol") == symbol)
                                         & (F.col("timeframe") == timeframe))
    return m.first()


def record_state(spark: SparkSession, root: str, symbols: DataFrame, asset_class: str, timeframe: str,
                 updated_at: str, *, years: Sequence[int] | None = None, keep_versions: int | None = None) -> int:
    """AG-1 + AG-2: recompute state of ``symbols`` from the stored bars (the
    authoritative source, so a crash before recording heals on rerun) and
    upsert it into a new manifest version. Runs after the data commit.

    State is kept per series and year (table ``series_years``): only the stored
    bars of ``years`` are read (None: all), and the manifest rolls the years up,
    so an increment does not read the history. The first record of a table reads
    all its years. ``keep_versions`` prunes older versions (off by default)."""
    keys = ["asset_class", "symbol", "timeframe", "year"]
    before = read_latest(spark, root, "series_years", SERIES_YEARS)
    own = (F.col("asset_class") == asset_class) & (F.col("timeframe") == timeframe)
    if before.where(own).isEmpty():
        years = None
    wanted = symbols.select("symbol").distinct()
    bars = read_bars(spark, root, asset_class=asset_class, timeframe=timeframe, years=years, with_partitions=True)
    bars = bars.select("symbol", "timestamp", "year").join(wanted, "symbol", "left_semi")
    profile = PROFILES.get(asset_class)
    date = profile.bar_date(F.col("timestamp"), timeframe) if profile else F.to_date("timestamp")
    counted = bars.groupBy(F.lit(asset_class).alias("asset_class"), "symbol", F.lit(timeframe).alias("timeframe"), "year") \
        .agg(F.min(date).alias("earliest_date"), F.max(date).alias("last_complete_date"),
             F.count(F.lit(1)).alias("bar_count"))
    redone = own if years is None else own & F.col("year").isin(list(years))
    marked = before.join(wanted.withColumn("_wanted", F.lit(True)), "symbol", "left")
    kept = marked.where(~(redone & F.coalesce("_wanted", F.lit(False)))).select(*SERIES_YEARS.fieldNames())
    by_year = pin(kept.unionByName(counted.select(*SERIES_YEARS.fieldNames())))
    write_version(by_year, root, "series_years")
    state = by_year.where(own).join(wanted, "symbol", "left_semi").groupBy(*keys[:3]).agg(
        F.min("earliest_date").alias("earliest_date"), F.max("last_complete_date").alias("last_complete_date"),
        F.sum("bar_count").alias("bar_count"))
    new_manifest = S.manifest_upsert(read_manifest(spark, root), state, updated_at)
    # Writing version N+1 never touches version N, which it reads.
    version = write_version(new_manifest, root, "manifest")
    if keep_versions is not None:
        for name in ("manifest", "series_years"):
            prune_versions(spark, root, name, keep=keep_versions)
    return version
