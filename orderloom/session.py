"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# What a task reads at most from files and from merged shuffle partitions, where the session does not say otherwise.
SCAN_BYTES, MERGED_BYTES = 16 << 20, 8 << 20
# Rows that a task exchanges with Python at a time, where the session does not say otherwise.
BATCH_ROWS = 1_000
# Folders made for local sessions that name no shared folder, by application.
_local_dirs: dict[str, str] = {}
# Where the tables that are still held were written to.
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Sessions whose queries have their shuffle files deleted: how often that was asked for, and the setting before.
_removing: dict[str, tuple[int, str | None]] = {}
_removing_lock = Lock()


def build_session(app: str = "orderloom", master: str | None = None, shuffle_partitions: int | None = None,
                  **confs: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster pass ``shuffle_partitions`` as about (largest shuffled table in bytes) / 128 MB; adaptive
    execution merges the small ones, but never splits a partition of an aggregation or a sort that was
    planned too coarse.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(confs)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def bound_tasks(spark: SparkSession) -> None:
    """Let no task of a scan get more than 16 MB as stored, and none behind a shuffle that Spark merges more than 8,
    where the session has Spark's defaults.

    Keys pack into a few bytes, so the defaults of 128 and 64 MB are up to ten million rows, all of them in the memory
    of one task that counts or sorts keys.
    """
    sizes = {"spark.sql.files.maxPartitionBytes": (128 << 20, SCAN_BYTES),
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": (64 << 20, MERGED_BYTES)}
    for name, (default, size) in sizes.items():
        if spark.conf.get(name) in (str(default), f"{default}b", f"{default >> 20}MB", f"{default >> 20}m"):
            spark.conf.set(name, f"{size >> 20}m")


def bound_batches(spark: SparkSession) -> None:
    """Let tasks hand rows to Python and take them back by 1,000 at most, where the session has Spark's default.

    Rows of long texts make the default of 10,000 some dozen megabytes, held by the executor and by Python, each twice.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it then gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="orderloom-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/orderloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that is run inside when the query ends.

    Spark keeps them otherwise until the driver's garbage collector finds that nothing refers to them, so a job of
    many steps holds the files of most of its steps at once. Threads that use one session may be inside at the same
    time; the last one to leave restores the setting.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    session = spark._jsparkSession.sessionUUID()
    with _removing_lock:
        inside, before = _removing.get(session, (0, spark.conf.get(name, None)))
        _removing[session] = inside + 1, before
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _removing_lock:
            inside, before = _removing.pop(session)
            if inside > 1:
                _removing[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote. Nothing that is still to be computed may read them."""
    for df in tables:
        path = _written.pop(df, None)
        if path is not None:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    Cuts the lineage, survives the loss of executors, and keeps the columnar layout, so that later readers
    still prune columns and push filters down.
    """
    return materialize_parts([df], label)


def materialize_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The same for the rows of all ``parts``, at least one, of which each is computed when those before are written."""
    path = None
    for df in parts:
        path = path or scratch_path(df.sparkSession, label)
        df.write.mode("append").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table
