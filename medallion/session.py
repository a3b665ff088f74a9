"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on for right results or for surviving skew; all can be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # State of streams on the executors' disks, not in their heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Concerns only tables whose schema names field ids (sources/contracts.py).
    "spark.sql.parquet.fieldId.read.enabled": "true",
}

# Where rows are wide, shuffles start with so many partitions, of which Spark joins small ones, and scans are cut finer:
# tasks are sized by what they read and not by a fixed number of tasks.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MANY_PARTITIONS = "400"
WIDE_TASKS = {INITIAL_PARTITIONS: MANY_PARTITIONS, "spark.sql.files.maxPartitionBytes": "32m"}
# Spark joins the operators of a stage in one method. With wide rows it gets so long that the JVM never compiles it (above
# 8,000 bytes) or is long about it; above this limit every operator has short methods of its own.
# Not for plans with many lookups, which would copy wide rows from join to join.
WIDE_CODE = {
    "spark.sql.codegen.hugeMethodLimit": "4000",
    # A balanced task writes to few folders: it keeps their files open instead of sorting its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in {**WIDE_TASKS, **WIDE_CODE}.items():
        if spark.conf.get(key, None) == value:
            spark.conf.unset(key)
    return spark


def _set_unless_chosen(spark: SparkSession, settings: dict[str, str]) -> None:
    for key, value in settings.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def size_tasks_by_rows(spark: SparkSession) -> None:
    """For the plans that run from now on until ``configure``; a number that the user has chosen stays."""
    _set_unless_chosen(spark, WIDE_TASKS)


def short_methods(spark: SparkSession) -> None:
    """The same for plans that make wide rows without many lookups: their code is compiled, and soon."""
    _set_unless_chosen(spark, WIDE_CODE)


def build_session(app_name: str = "medallion", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above. Pass cluster sizing (executors, shuffle partitions) in ``settings``."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_dirs.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="medallion-")
        _local_dirs[context.applicationId] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one intermediate table of this application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/medallion-scratch/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it when no frame that reads them is in use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the cluster has already done so."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
