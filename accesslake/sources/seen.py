"""Which lines have been seen, as digests, so that later runs drop them without reading them again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.operators.joins import anti_join
from accesslake.session import scratch_path
from accesslake.sources import tables

SEEN = "digest binary, n bigint, prefix int"


def line_digest(line: Column) -> Column:
    """128 bits of a line's SHA2-256."""
    return F.unhex(F.substring(F.sha2(line.cast("binary"), 256), 1, 32))


def first_rows(staged: DataFrame) -> DataFrame:
    """(digest, row_id, n, prefix): the first row of each digest, by hash aggregation."""
    found = staged.groupBy("digest").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n"))
    return found.withColumn("prefix", F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int"))


@dataclass(frozen=True)
class SeenLines:
    """Digests of lines by run, partitioned by the first byte of the digest.

    A run's digests are written to a folder of its own, and a run that is repeated is held against those before it only, so that
    it gives the same lines again. ``compact`` folds the runs so far.
    """

    root: str

    def _runs(self, spark: SparkSession) -> list[int]:
        names = tables.child_names(spark, f"{self.root}/runs")
        return sorted(int(n.removeprefix("run=")) for n in names if n.startswith("run="))

    def before(self, spark: SparkSession, run: int) -> DataFrame:
        """Digests of all runs before one."""
        base = f"{self.root}/base"
        start = tables.current_version(spark, base) or 0
        if start > run:
            raise ValueError(f"run {run} has been folded with later ones")
        folders = [f"{self.root}/runs/run={r}" for r in self._runs(spark) if start <= r < run]
        parts = [spark.read.schema(SEEN).parquet(f) for f in folders + ([f"{base}/v{start}"] if start else [])]
        rows = spark.createDataFrame([], SEEN)
        for part in parts:
            rows = rows.unionByName(part)
        return rows

    def take(self, lines: DataFrame, run: int) -> DataFrame:
        """The lines that no earlier run has seen, each once at its first ``row_id``, with ``n`` copies; stored below the run.

        ``lines`` come from ``scan_logs``. They are stored with their digests, as row ids of two scans may differ. Digests and ids, which are
        of fixed width, are grouped by hash aggregation and held against the ledger; then the rows chosen are picked
        out by id. No text is a key of a shuffle.
        """
        spark = lines.sparkSession
        staging, out = scratch_path(spark, "seen"), f"{self.root}/new/run={run}"
        lines.withColumn("digest", line_digest(F.col("line"))).write.parquet(staging)
        staged = spark.read.parquet(staging)
        fresh = anti_join(first_rows(staged), self.before(spark, run), ["prefix", "digest"], unique=True)
        path = f"{self.root}/runs/run={run}"
        fresh.hint("rebalance", "prefix").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("prefix").parquet(path)
        chosen = spark.read.schema("digest binary, row_id bigint, n bigint, prefix int").parquet(path).select("row_id", "n")
        staged.join(chosen, "row_id").drop("digest").write.mode("overwrite").parquet(out)
        tables.drop_path(spark, staging)
        return spark.read.parquet(out)

    def compact(self, spark: SparkSession) -> None:
        """Fold the digests of all runs; run it while none is being written."""
        runs = self._runs(spark)
        version = runs[-1] + 1 if runs else 0
        if version > (tables.current_version(spark, f"{self.root}/base") or 0):
            rows = self.before(spark, version).hint("rebalance", "prefix")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("prefix").parquet(f"{self.root}/base/v{version}")
