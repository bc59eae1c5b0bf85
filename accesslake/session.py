"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLE_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000

#: Allocators of Python workers: what one stage has freed goes back to the machine, as workers wait beside their executor for the next.
WORKER_ENV = {
    "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "131072", "MALLOC_TRIM_THRESHOLD_": "131072",
    "ARROW_DEFAULT_MEMORY_POOL": "system", "OPENBLAS_NUM_THREADS": "1",
}

_shipped: dict[str, str] = {}


def get_session(app_name: str = "accesslake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots.

    AQE joins small shuffle partitions and splits those a hot key has blown up; how many it starts
    from is set per job by ``sized_shuffles``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def lean_workers(spark: SparkSession) -> None:
    """Give Python workers of functions made from now on WORKER_ENV, except for what the session has set itself."""
    environment = spark.sparkContext.environment
    environment.update({k: v for k, v in WORKER_ENV.items() if k not in environment})


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once a context, so that they find it wherever they are started."""
    context = spark.sparkContext
    lean_workers(spark)
    if _shipped.get("context") == context.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="accesslake-"), "accesslake.zip")  # the driver's; Spark sends it on
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("accesslake", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped["context"] = context.applicationId


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master that names none.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="accesslake-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def sized_shuffles(scanned: DataFrame, partition_bytes: int = SHUFFLE_BYTES) -> Iterator[int]:
    """Let shuffles inside the block start from one partition per so many bytes of ``scanned``.

    AQE can join partitions but does not split even ones, so a fixed number is too few for some
    input. The size is Catalyst's own for a table scan; where it has none the session's number stays.
    """
    spark = scanned.sparkSession
    size = int(scanned._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < 1 << 60:
        partitions = max(partitions, min(-(-size // partition_bytes), MAX_SHUFFLE_PARTITIONS))
    before = spark.conf.get(INITIAL_PARTITIONS_CONF, None)
    spark.conf.set(INITIAL_PARTITIONS_CONF, partitions)
    try:
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS_CONF)
        else:
            spark.conf.set(INITIAL_PARTITIONS_CONF, before)
