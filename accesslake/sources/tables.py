"""Star-schema tables as Parquet.

``downloads`` is partitioned by day and changed a whole day at a time. Dimension tables are replaced
by snapshots: every version is a new folder, the highest one that Spark has marked complete is
current, and none is written while it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SUCCESS, COMPLETE = "_SUCCESS", "_COMPLETE"
#: Versions kept besides the current one, for readers that still hold them.
OLD_VERSIONS = 5


def filesystem_of(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which is there whole or not at all."""
    filesystem, target = filesystem_of(spark, path)
    _, unfinished = filesystem_of(spark, f"{path}.unfinished")
    out = filesystem.create(unfinished, True)
    out.write(bytearray(text.encode()))
    out.close()
    filesystem.rename(unfinished, target)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    filesystem, source = filesystem_of(spark, path)
    stream = filesystem.open(source)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = filesystem_of(spark, path)
    return filesystem.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where it does not exist."""
    filesystem, hadoop_path = filesystem_of(spark, path)
    if not filesystem.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some paths or patterns that name a file or folder; names that look like patterns are escaped."""
    found = []
    for path in paths:
        filesystem, hadoop_path = filesystem_of(spark, path)
        if filesystem.exists(hadoop_path):
            found.append(re.sub(r"([\[\]{}*?])", r"\\\1", path))
        elif filesystem.globStatus(hadoop_path):
            found.append(path)
    return found


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[1:]) for n in child_names(spark, root) if n.startswith("v") and n[1:].isdigit())


def current_version(spark: SparkSession, root: str) -> int | None:
    """Highest complete version of a snapshot table.

    ``write_snapshot`` marks a version last; Spark's own marker counts too. A version without either that holds data
    and no unfinished work is not passed over: it may be the table.
    """
    for version in reversed(_versions(spark, root)):
        names = child_names(spark, f"{root}/v{version}")
        if SUCCESS in names or COMPLETE in names:
            return version
        if "_temporary" not in names and any(n.startswith("part-") for n in names):
            raise ValueError(f"{root}/v{version} has data but no marker; add {COMPLETE} if it is whole, or remove it")
    return None


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Current version of a table; empty when there is none yet."""
    version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v{version}")


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write the next version. ``df`` may read the current one."""
    spark = df.sparkSession
    version = max(_versions(spark, root), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{root}/v{version}")
    filesystem, marker = filesystem_of(spark, f"{root}/v{version}/{COMPLETE}")
    filesystem.create(marker, True).close()
    for old in _versions(spark, root):
        if old < version - OLD_VERSIONS:
            drop_path(spark, f"{root}/v{old}")
    return version


def append_facts(facts: DataFrame, path: str) -> None:
    """Add facts to the table partitioned by day.

    Rows are rebalanced by day: AQE joins small days into one writer and splits a busy day over
    several, so no day becomes many tiny files or one huge task.
    """
    facts.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)


def read_facts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def replace_days(facts: DataFrame, path: str, staging: str) -> None:
    """Replace the days present in ``facts``; other days are not touched.

    The rows are written to ``staging`` first, as they are usually computed from the days they
    replace. If the job is lost while days are swapped, ``swap_days`` from there finishes it.
    """
    facts.write.mode("overwrite").parquet(staging)
    swap_days(facts.sparkSession, staging, path, facts.schema)


def swap_days(spark: SparkSession, staging: str, path: str, schema: T.StructType) -> None:
    """Put staged days in place of a table's own; the same however often it is done."""
    overwrite_partitions(spark.read.schema(schema).parquet(staging), path, "dt")


def overwrite_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Write rows in place of the partitions they are in. ``rows`` must not be read from ``path``."""
    writer = rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in another's place."""
    filesystem, to = filesystem_of(spark, target)
    filesystem.delete(to, True)
    filesystem.mkdirs(to.getParent())
    if not filesystem.rename(filesystem_of(spark, source)[1], to):
        raise OSError(f"{source} could not be moved to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that is not needed any more."""
    filesystem, hadoop_path = filesystem_of(spark, path)
    filesystem.delete(hadoop_path, True)
