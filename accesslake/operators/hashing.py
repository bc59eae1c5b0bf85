"""Hashing the content of stored objects."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from accesslake.sources.objects import open_filesystem

# Fixed value: block size of content reads.
READ_BLOCK = 65_536

RESULT = pa.schema(
    [
        ("s3key", pa.string()),
        ("etag", pa.string()),
        ("mtime", pa.timestamp("us", tz="UTC")),
        ("declared_bytes", pa.int64()),
        ("bytes", pa.int64()),
        ("sha2_256", pa.string()),
        ("sha3_256", pa.string()),
        ("seconds", pa.float64()),
        ("error", pa.string()),
    ]
)
RESULT_DDL = (
    "s3key string, etag string, mtime timestamp, declared_bytes bigint, bytes bigint, "
    "sha2_256 string, sha3_256 string, seconds double, error string"
)


def _digest_stream(uri: str) -> tuple[int, str, str]:
    """Both digests in one pass over an object, in blocks, so its size does not matter to memory."""
    filesystem, path, _ = open_filesystem(uri)
    sha2, sha3, size = hashlib.sha256(), hashlib.sha3_256(), 0
    with filesystem.open_input_stream(path) as stream:
        while block := stream.read(READ_BLOCK):
            sha2.update(block)
            sha3.update(block)
            size += len(block)
    return size, sha2.hexdigest(), sha3.hexdigest()


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            start = time.perf_counter()
            size, sha2, sha3, error = None, None, None, None
            try:
                size, sha2, sha3 = _digest_stream(row["uri"])
            except FileNotFoundError:
                error = "not found"
            except OSError as failure:
                error = f"unreadable: {failure.strerror or type(failure).__name__}"
            else:
                if size != row["bytes"]:
                    error = "length differs"
            result = {
                "s3key": row["s3key"],
                "etag": row["etag"],
                "mtime": row["mtime"],
                "declared_bytes": row["bytes"],
                "bytes": size,
                "sha2_256": sha2,
                "sha3_256": sha3,
                "seconds": time.perf_counter() - start,
                "error": error,
            }
            yield pa.RecordBatch.from_pylist([result], schema=RESULT)


#: Blocks whose sizes are summed up to deal objects out, and what opening an object costs, as bytes.
DEALT_BLOCKS = 4096
OBJECT_COST = 65_536
TASK_BYTES = 4 << 30


def deal_by_size(objects: DataFrame, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """Objects with a ``slot``, and the number of slots: one after another, each takes its bytes of a line cut every ``task_bytes``.

    A slot holds the objects that start in its stretch, so it has less than ``task_bytes`` besides its last object,
    and objects of that size never share one. The line runs through blocks of a hash of the key: their sizes are added
    up over all blocks, and within each block over its objects. Fewer bytes a task are taken where there are less than one for each core.
    """
    weight = F.coalesce(F.col("bytes"), F.lit(0)) + OBJECT_COST
    rows = objects.withColumns({"_weight": weight, "_block": F.pmod(F.xxhash64("s3key"), F.lit(DEALT_BLOCKS)).cast("int")})
    sizes = rows.groupBy("_block").agg(F.sum("_weight").alias("_size"))
    ahead = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # a row for each block
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"))
    total = sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    step = max(1, min(task_bytes, total // objects.sparkSession.sparkContext.defaultParallelism))
    before = W.partitionBy("_block").orderBy("s3key", "uri").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_offset") + F.coalesce(F.sum("_weight").over(before), F.lit(0))
    dealt = rows.join(F.broadcast(offsets), "_block").withColumn("slot", F.floor(start / step).cast("int"))
    return dealt.select(*objects.columns, "slot"), total // step + 1


def hash_dealt(dealt: DataFrame, first: int, slots: int, tasks: int | None = None) -> DataFrame:
    """Digest the objects of ``slots`` slots from ``first`` on, a task for each, or evenly in so many ``tasks`` if there are more slots."""
    tasks = min(slots, tasks or slots)
    own = dealt.filter(F.col("slot").between(first, first + slots - 1))
    wanted = own.select("s3key", "uri", "etag", F.col("mtime").cast("timestamp").alias("mtime"), "bytes", F.pmod(F.col("slot") - first, F.lit(tasks)).alias("slot"))
    return wanted.repartitionById(tasks, "slot").drop("slot").mapInArrow(_hash_rows, RESULT_DDL)


def hash_objects(objects: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Digest every object of a table (s3key, uri, etag, mtime, bytes).

    One row per object; ``error`` says why an object has no usable digest. An object's content is
    streamed through the task that hashes it and never becomes a column. A lost executor costs the
    objects of its running tasks.
    """
    dealt, slots = deal_by_size(objects, task_bytes)
    return hash_dealt(dealt, 0, slots)


def hash_rejects(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNotNull()).select("s3key", "declared_bytes", "bytes", "error")


def hash_good(results: DataFrame) -> DataFrame:
    """Rows for ``apply_hashes``."""
    return results.filter(F.col("error").isNull()).select(
        "s3key", "etag", "mtime", "bytes", "sha2_256", "sha3_256"
    )


def hash_throughput(results: DataFrame) -> DataFrame:
    """One row: objects, bytes, task seconds, megabytes per task second."""
    done = results.filter(F.col("error").isNull())
    return done.agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.sum("bytes").alias("bytes"),
        F.sum("seconds").alias("seconds"),
        F.try_divide(F.sum("bytes") / F.lit(1e6), F.sum("seconds")).alias("mb_per_second"),
    )
