"""Which log files have been taken in, so that each is taken once and may then be deleted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.sources import tables
from accesslake.sources.objects import open_filesystem

FILE = "uri string, etag string, mtime timestamp, bytes bigint"
NAME = "uri", "etag"


@dataclass(frozen=True)
class FileLedger:
    """Files by batch. A batch is planned, then taken in, then committed.

    A planned batch that is not committed was cut off and is done again with the same files. A file
    is known by its URI and ETag: a file that has changed is another one. Committed batches can be folded
    into one table by ``compact``.
    """

    root: str

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        names = tables.child_names(spark, f"{self.root}/{kind}")
        return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=") and n[9:].isdigit())

    def planned_path(self, batch: int) -> str:
        return f"{self.root}/planned/batch_id={batch}"

    def open_batch(self, spark: SparkSession) -> int | None:
        """The batch that was planned whole and not committed."""
        committed = set(self._numbers(spark, "committed"))
        planned = [n for n in self._numbers(spark, "planned") if tables.path_exists(spark, f"{self.planned_path(n)}/_SUCCESS")]
        left = [n for n in planned if n not in committed]
        return left[0] if left else None

    def files(self, spark: SparkSession, batch: int) -> DataFrame:
        """The files of one batch."""
        return spark.read.schema(FILE).parquet(self.planned_path(batch))

    def committed(self, spark: SparkSession) -> DataFrame:
        """All files taken in."""
        base, version = f"{self.root}/base", tables.current_version(spark, f"{self.root}/base") or 0
        batches = [self.planned_path(n) for n in self._numbers(spark, "committed") if n >= version]
        rows = spark.read.schema(FILE).parquet(*batches) if batches else spark.createDataFrame([], FILE)
        return rows.unionByName(spark.read.schema(FILE).parquet(f"{base}/v{version}")) if version else rows

    def pending(self, listing: DataFrame) -> DataFrame:
        """Listed files that have not been taken in."""
        known = self.committed(listing.sparkSession).select(*NAME).distinct()
        return listing.join(known, list(NAME), "left_anti").select(*[c.split()[0] for c in FILE.split(", ")])

    def deletable(self, listing: DataFrame) -> DataFrame:
        """Listed files that have been taken in; nothing else may be deleted."""
        return listing.join(self.committed(listing.sparkSession).select(*NAME).distinct(), list(NAME), "left_semi")

    def plan(self, listing: DataFrame, most: int) -> int | None:
        """Plan the next batch: the oldest pending files, at most ``most``. None where nothing is pending."""
        batch = max(self._numbers(listing.sparkSession, "committed"), default=-1) + 1
        return batch if self.replan(batch, self.pending(listing).orderBy("mtime", "uri").limit(most)) else None

    def replan(self, batch: int, files: DataFrame) -> bool:
        """Write the files of a batch that is not committed; a batch of no files is no batch."""
        spark, path = files.sparkSession, self.planned_path(batch)
        files.write.mode("overwrite").parquet(path)
        if self.files(spark, batch).isEmpty():
            tables.drop_path(spark, path)
            return False
        return True

    def commit(self, spark: SparkSession, batch: int) -> None:
        tables.write_text(spark, f"{self.root}/committed/batch_id={batch}", "")

    def compact(self, spark: SparkSession, least: int = 1) -> None:
        """Fold all committed batches into one table, if there are so many new ones; run it while nothing is taken in."""
        version = max(self._numbers(spark, "committed"), default=-1) + 1
        if version >= (tables.current_version(spark, f"{self.root}/base") or 0) + least:
            self.committed(spark).write.mode("overwrite").parquet(f"{self.root}/base/v{version}")


def _look(batches: Iterator[pa.RecordBatch], delete: bool) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        same = []
        for row in batch.to_pylist():
            system, path, _ = open_filesystem(row["uri"])
            found = system.get_file_info(path)
            same.append(found.type == fs.FileType.File and found.size == row["bytes"] and found.mtime_ns // 1000 == row["micros"])
            if delete and same[-1]:
                system.delete_file(path)
        yield pa.RecordBatch.from_pydict({"uri": batch.column("uri"), "same": pa.array(same, pa.bool_())})


def _looked_at(files: DataFrame, delete: bool = False) -> DataFrame:
    rows = files.select("uri", "bytes", F.unix_micros(F.col("mtime").cast("timestamp")).alias("micros"))
    spread = rows.repartition(files.sparkSession.sparkContext.defaultParallelism, "uri")
    return spread.mapInArrow(lambda batches: _look(batches, delete), "uri string, same boolean")


def delete_files(files: DataFrame) -> int:
    """Delete files in tasks; returns how many. One that has changed since it was listed stays."""
    return _looked_at(files, delete=True).agg(F.count_if("same")).first()[0]


def changed_files(files: DataFrame) -> list[str]:
    """URIs of files that are not as they were listed, or gone. At most as many as given."""
    return [r.uri for r in _looked_at(files).filter("not same").collect()]
