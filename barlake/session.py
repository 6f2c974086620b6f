"""Spark session and shared-folder helpers.

Every job in this package assumes the session time zone is UTC: bar times are
instants, and the supplied tables carry naive (``timestamp_ntz``) wall-clock
values that are read as UTC.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this package needs, whatever builds it.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only touched partitions are rewritten by a merge (SRC-6).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as tickers must stay strings ("1E5" is not a decimal).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A listing of many folders is this many tasks (by default one per folder, up to 10,000).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that hold whole texts: a batch of this many stays a few MB on both sides.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(master: str | None = None, app: str = "barlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable package settings to an existing session."""
    for key, value in SESSION_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static settings of a session built elsewhere
            pass
    return spark


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_files(spark: SparkSession, n: int):
    """While this holds, writes by partition keep up to ``n`` files of a task open, so that
    its rows are not sorted by partition first (only those of further partitions are)."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(n))


def small_files(spark: SparkSession):
    """While this holds, a scan that runs takes about a thousand small files to a task
    (Spark's default is 32, so that tasks, not bytes, would set the time)."""
    return _setting(spark, "spark.sql.files.openCostInBytes", str(128 * 1024))


def uncached_listing(spark: SparkSession):
    """While this holds, a reader's listing is not kept for readers of the same paths (the
    driver would keep up to 250 MB of it)."""
    return _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``. Where that is unset, a local
    master (tests, a laptop) gets a fresh scratch folder, registered on the
    session; on a cluster it is an error, since executors share no local folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="barlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused between runs)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def pin(df):
    """Materialise ``df`` once with a reliable checkpoint in the shared folder:
    later uses read the written copy (no recomputation, lineage cut, and it
    survives the loss of the executors that computed it)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
