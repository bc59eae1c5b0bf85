"""Continuous log ingest.

Every micro-batch writes to folders named after it, and a batch that is run again after a failure
overwrites just those. With the query's checkpoint this makes each line count once. A landing zone
and the checkpoint of its query belong together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accesslake import schemas
from accesslake.operators.star import agent_additions, catalog_additions, fact_rows
from accesslake.plans.ingest import MALFORMED, classified_lines, land, landed_schema
from accesslake.sources.tables import child_names, current_version, path_exists


@dataclass(frozen=True)
class Landing:
    """Tables a stream writes, a folder per micro-batch.

    Dimension rows of many batches can be folded into one snapshot by ``compact``; its version is the
    first batch not in it, and only later batches' folders are looked at then.
    """

    root: str

    def batch_path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch_id={batch_id}"

    def _read(self, spark: SparkSession, name: str, ddl: str, batches: list[int] | None = None) -> DataFrame:
        """A table, or just some batches of it; other batches' folders are not listed then."""
        if batches is None:
            batches = self._batches(spark, name)
        if not batches:
            return spark.createDataFrame([], ddl)
        reader = spark.read.schema(ddl).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[self.batch_path(name, b) for b in batches])

    def _batches(self, spark: SparkSession, name: str) -> list[int]:
        names = child_names(spark, f"{self.root}/{name}")
        return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))

    def is_whole(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a batch has been landed to its end: the archive is written last."""
        return path_exists(spark, f"{self.batch_path('archive', batch_id)}/_SUCCESS")

    def records(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        return self._read(spark, "records", landed_schema("dt date", "batch_id bigint"), batches)

    def downloads(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        return self.records(spark, batches).filter(F.col("class") == schemas.DOWNLOAD)

    def malformed(self, spark: SparkSession) -> DataFrame:
        return self.records(spark).filter(F.col("class") == MALFORMED).select("line", "parse_error")

    def facts(self, spark: SparkSession) -> DataFrame:
        return fact_rows(self.downloads(spark))

    def _dimension(self, spark: SparkSession, name: str, schema: T.StructType, before: int | None) -> DataFrame:
        base = f"{self.root}/{name}_base"
        start = current_version(spark, base) or 0
        late = [b for b in self._batches(spark, name) if b >= start and (before is None or b < before)]
        rows = self._read(spark, name, _ddl(schema), late)
        if start:
            rows = rows.unionByName(spark.read.schema(_ddl(schema)).parquet(f"{base}/v{start}"))
        return rows if before is None else rows.filter(F.col("batch_id") < before)

    def catalog(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._dimension(spark, "downloadable", schemas.DOWNLOADABLE, before)

    def agents(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._dimension(spark, "user_agents", schemas.USER_AGENTS, before)

    def class_counts(self, spark: SparkSession) -> DataFrame:
        counts = self._read(spark, "class_counts", "class string, n bigint, batch_id bigint")
        return counts.groupBy("class").agg(F.sum("n").alias("n"))

    def compact(self, spark: SparkSession) -> None:
        """Fold the dimension rows of all batches so far; run it while no batch is being written."""
        for name, rows in (("downloadable", self.catalog(spark)), ("user_agents", self.agents(spark))):
            batches = self._batches(spark, name)
            version = batches[-1] + 1 if batches else 0
            if version > (current_version(spark, f"{self.root}/{name}_base") or 0):
                rows.write.mode("overwrite").parquet(f"{self.root}/{name}_base/v{version}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", batch_id bigint"


def land_batch(
    lines: DataFrame,
    batch_id: int,
    landing: Landing,
    log_format: str,
    ignored: DataFrame | None = None,
    mode: str = "quarantine",
) -> None:
    """Parse and store one micro-batch."""
    spark = lines.sparkSession

    def path(name: str) -> str:
        return landing.batch_path(name, batch_id)

    counts = land(classified_lines(lines, log_format, ignored, mode), path("records"), ("class", "dt"))
    tally = spark.createDataFrame([(c, n) for c, n in counts.items() if n], "class string, n bigint")
    tally.write.mode("overwrite").parquet(path("class_counts"))

    downloads = landing.downloads(spark, [batch_id])
    files = catalog_additions(downloads, landing.catalog(spark, before=batch_id))
    files.write.mode("overwrite").parquet(path("downloadable"))
    agents = agent_additions(downloads, landing.agents(spark, before=batch_id))
    agents.write.mode("overwrite").parquet(path("user_agents"))
    archived = downloads.select(F.year("dtime_local").alias("year"), "line")
    archive = archived.write.mode("overwrite").option("partitionOverwriteMode", "static")
    archive.partitionBy("year").text(path("archive"))


def ingest_stream(
    lines: DataFrame,
    landing: Landing,
    checkpoint: str,
    log_format: str,
    ignored: DataFrame | None = None,
    mode: str = "quarantine",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start ingest; ``available_now`` takes what is there and stops, for runs from a timer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, landing, log_format, ignored, mode)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
