"""Object listings."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.session import scratch_path
from accesslake.sources import tables
from accesslake.sources.objects import open_filesystem

_ENTRY = pa.schema(
    [
        ("uri", pa.string()),
        ("folder", pa.bool_()),
        ("mtime", pa.timestamp("us", tz="UTC")),
        ("bytes", pa.int64()),
    ]
)
_ENTRY_DDL = "uri string, folder boolean, mtime timestamp, bytes bigint"
_ENTRIES_PER_BATCH = 10_000
#: Files of a tree that the driver looks at itself.
DRIVER_ENTRIES = 1000


def split_object_url(url: str) -> tuple[str, str]:
    """Bucket and key prefix of an object URL; the prefix has no leading slash."""
    parts = urlsplit(url)
    return parts.netloc, parts.path.removeprefix("/")


def _batches(entries: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """(path, folder, microseconds, bytes) tuples as batches of bounded size."""
    while chunk := list(islice(entries, _ENTRIES_PER_BATCH)):
        paths, folders, times, sizes = zip(*chunk)
        columns = [
            pa.array(paths, pa.string()),
            pa.array(folders, pa.bool_()),
            pa.array(times, pa.int64()).cast(pa.timestamp("us", tz="UTC")),
            pa.array(sizes, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_ENTRY)


def _described(found: Sequence[fs.FileInfo], before: str) -> Iterator[tuple]:
    for i in found:
        if i.type != fs.FileType.NotFound:
            micros = None if i.mtime_ns is None else i.mtime_ns // 1000
            yield before + i.path, i.type == fs.FileType.Directory, micros, i.size


def _folder_entries(uri: str) -> Iterator[tuple]:
    """A folder's entries. Those of a file system are streamed by name, without time and size; a store's pages have both."""
    system, path, before = open_filesystem(uri)
    if not isinstance(system, fs.LocalFileSystem):
        yield from _described(system.get_file_info(fs.FileSelector(path, allow_not_found=True)), before)
        return
    try:
        with os.scandir(path) as entries:
            for entry in entries:
                yield before + path.rstrip("/") + "/" + entry.name, entry.is_dir(), None, None
    except FileNotFoundError:
        return


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uris = (uri for batch in batches for uri in batch.column("uri").to_pylist())
    return _batches(entry for uri in uris for entry in _folder_entries(uri))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Time and size of files known by name; what has vanished meanwhile is left out."""
    for batch in batches:
        uris = batch.column("uri").to_pylist()
        for start in range(0, len(uris), _ENTRIES_PER_BATCH):
            chunk = uris[start : start + _ENTRIES_PER_BATCH]
            system, _, before = open_filesystem(chunk[0])
            yield from _batches(_described(system.get_file_info([open_filesystem(uri)[1] for uri in chunk]), before))


def described(files: DataFrame) -> DataFrame:
    """Files with time and size, stored. Names without are looked up once, in tasks that share them evenly, whatever folders they are in."""
    spark = files.sparkSession
    unknown = files.filter("bytes is null").select("uri").repartition(spark.sparkContext.defaultParallelism, "uri")
    path = scratch_path(spark, "listed")
    files.filter("bytes is not null").unionByName(unknown.mapInArrow(_describe, _ENTRY_DDL)).write.parquet(path)
    return spark.read.schema(_ENTRY_DDL).parquet(path)


def walk(spark: SparkSession, starts: Sequence[str], keep: Callable[[DataFrame], DataFrame], limit: int | None = None) -> DataFrame:
    """Names of all entries below some folders, with time and size where a store's pages give them.

    Each round lists the folders the last one found, in parallel tasks, and writes what it finds; there are as many
    rounds as folder levels, one less deep where ``limit`` files are found before.
    """
    path = scratch_path(spark, "listing")
    tasks = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(uri,) for uri in starts], "uri string")
    level, files = 0, 0
    while True:
        here = f"{path}/level={level}"
        keep(folders.repartition(tasks, "uri").mapInArrow(_list_folders, _ENTRY_DDL)).write.parquet(here)
        entries = spark.read.schema(_ENTRY_DDL).parquet(here)
        folders = entries.filter("folder").select("uri")
        if limit is not None:
            files += entries.filter("not folder").count()
        if folders.isEmpty() or (limit is not None and files >= limit):
            return spark.read.schema(_ENTRY_DDL + ", level int").parquet(path).drop("level")
        level += 1


def _is_hidden(name: Column) -> Column:
    return F.substring(name, 1, 1).isin(".", "_") & ~F.contains(name, F.lit("="))


def _hidden_below(spark: SparkSession, root: str, most: int) -> list[str]:
    """Hidden files with content below a folder, found in tasks: only hidden names are looked up."""
    system, path, before = open_filesystem(root.rstrip("/") + "/")
    base = before + path.rstrip("/") + "/"
    names = F.split(F.substring(F.col("uri"), F.lit(len(base) + 1), F.length("uri")), "/")
    found = walk(spark, [base.rstrip("/")], lambda entries: entries).filter(~F.col("folder") & F.exists(names, _is_hidden))
    return [r.uri for r in described(found).filter("bytes > 0").select("uri").limit(most).collect()]


def hidden_files(spark: SparkSession, paths: Sequence[str], most: int = 20) -> list[str]:
    """Up to ``most`` files with content that Spark's file sources pass over for a name that starts with a dot or an underscore.

    The driver looks at DRIVER_ENTRIES files at most; larger trees are walked in tasks, with the same result.
    """
    found: list[str] = []
    for path in paths:
        filesystem, hadoop_path = tables.filesystem_of(spark, path)
        for status in filesystem.globStatus(hadoop_path) or []:
            below = len(status.getPath().getParent().toString())
            files, seen, here = filesystem.listFiles(status.getPath(), True), 0, []
            while files.hasNext() and seen < DRIVER_ENTRIES:
                entry, seen = files.next(), seen + 1
                names = entry.getPath().toString()[below:].split("/")
                if entry.getLen() and any(n[:1] in (".", "_") and "=" not in n for n in names):
                    here.append(entry.getPath().toString())
            if files.hasNext():
                here = _hidden_below(spark, status.getPath().toString(), most)
            found += here
    return found[:most]


def list_objects(spark: SparkSession, root: str, prefix: str = "", limit: int | None = None) -> DataFrame:
    """Every object below ``root`` as (s3key, uri, etag, mtime, bytes), without reading content.

    Keys are relative to ``root``; empty objects and names that start with a dot or an underscore are
    listed too, which Spark's file sources skip. Only folders that can hold ``prefix`` are walked. A
    root that does not exist is an error; a folder below it that vanishes meanwhile is empty.
    A file system has no ETags, so one is made of length and modification time. ``limit`` keeps so
    many entries, any of them, as a listing has no set order.

    A folder's names are streamed by one task, in bounded memory, and times and sizes are looked up by all tasks,
    which share the names evenly, however many a folder has. Object stores give times and sizes with the names, a
    folder at a time; for buckets with very many objects in one folder use the store's inventory: any table with
    these columns is a listing.
    """
    system, path, before = open_filesystem(root.rstrip("/") + "/")
    if system.get_file_info(path.rstrip("/") or "/").type == fs.FileType.NotFound:
        raise FileNotFoundError(f"nothing to list at {root}")
    base = before + path.rstrip("/") + "/"
    skip = len(base)
    key = F.substring(F.col("uri"), F.lit(skip + 1), F.length("uri"))
    start = base + prefix.rpartition("/")[0]

    def keep(entries: DataFrame) -> DataFrame:
        below = key.startswith(prefix)
        return entries.filter(below | (F.col("folder") & F.startswith(F.lit(prefix), F.concat(key, F.lit("/")))))

    names = walk(spark, [start.rstrip("/")], keep, limit).filter("not folder")
    files = described(names if limit is None else names.limit(limit))
    listed = files.select(
        key.alias("s3key"),
        "uri",
        F.format_string('"%x-%x"', F.unix_micros("mtime"), F.col("bytes")).alias("etag"),
        "mtime",
        "bytes",
    )
    return listed
