"""Session settings and tables staged in the shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed stream state with timers is kept outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# A query lets go of its shuffle files when it ends, and not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BATCH_BYTES = "4m"  # of a batch that goes to a Python worker; both sides hold batches whole, outside the JVM heap

_local_dirs: dict[str, str] = {}


def build_session(app: str = "flowlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches of wide rows by their bytes, for what this session runs from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="flowlens-")
    return _local_dirs[context.applicationId]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, as Spark itself resolves it."""
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(named).toString()


def _work_dir(spark: SparkSession) -> str:
    return f"{qualified(spark, shared_dir(spark))}/flowlens/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def work_path(spark: SparkSession, name: str) -> str:
    """The path of this name below the application's folder; the same whenever it is asked for."""
    return f"{_work_dir(spark)}/{name}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged. Call it once no table built on it is read any more."""
    drop_path(spark, _work_dir(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several jobs read one expensive result. The lineage ends at the files, so a
    lost executor costs a re-read and not the aggregation behind it, and later scans still
    get column pruning and pushed filters.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block let go of their shuffle files when they are done; what is read afterwards is the written files."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
