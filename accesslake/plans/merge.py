"""Merge log files into one sorted log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from accesslake.operators.classify import nonblank_lines
from accesslake.operators.merge import POSITION, distinct_records, report_records, sort_records
from accesslake.operators.parse import good_records, parse_logs
from accesslake.session import scratch_path, sized_shuffles
from accesslake.sources.journal import Journal
from accesslake.sources.logs import read_lines, scan_logs, write_merged
from accesslake.sources.tables import child_names, drop_path


def merge_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    out: str,
    log_format: str,
    year: int | None = None,
    mode: str = "failfast",
) -> Row:
    """Write the distinct lines of all inputs in time order; returns the report.

    Distinct lines are stored once. A global sort reads its input twice, first to choose the ranges,
    and the report reads it again; none of them repeats the shuffle of raw lines or the parsing.
    """
    staging = scratch_path(spark, "merge")
    lines = scan_logs(spark, paths)
    with sized_shuffles(lines):
        distinct = distinct_records(lines, log_format, year, mode)
        distinct.select("line", "dtime", "position", "n", "kept").write.parquet(staging)
        staged = spark.read.parquet(staging)
        write_merged(sort_records(staged), out)
        report = report_records(staged).first()
    drop_path(spark, staging)
    return report


@dataclass(frozen=True)
class MergedLog:
    """A merged log that new files are merged into, a day (UTC) at a time.

    A line lies in the folder of its day, and the folders, then the files of each, in the order of their names are the
    whole log. Equal lines are of one day. So new lines concern the days they fall on: these are read, merged and replaced,
    and no other is listed, read or written. Days are put in place through a journal, which finishes what a lost job has
    staged.
    """

    root: str
    log_format: str

    @property
    def journal(self) -> Journal:
        return Journal(self.root)

    def days(self, spark: SparkSession) -> list[str]:
        """Days that have lines."""
        return sorted(n.removeprefix("day=") for n in child_names(spark, f"{self.root}/log") if n.startswith("day="))

    def lines(self, spark: SparkSession, days: list[str] | None = None) -> DataFrame:
        """Lines of some days, or of all, with their positions."""
        wanted = [d for d in self.days(spark) if days is None or d in days]
        if not wanted:
            return spark.createDataFrame([], "line string, file_path string, file_block_start bigint, row_id bigint")
        return read_lines(spark, [f"{self.root}/log/day={d}" for d in wanted])

    def stage(self, spark: SparkSession, paths: str | Sequence[str], year: int | None = None, mode: str = "failfast") -> list[str]:
        """Stage the days that new files have lines of; returns them. Calendar days are all that reaches the driver."""
        self.journal.finish(spark)
        staging = scratch_path(spark, "merge-more")
        fresh = scan_logs(spark, paths)
        with sized_shuffles(fresh):
            records = good_records(parse_logs(nonblank_lines(fresh), self.log_format), mode)
            if year is not None:
                records = records.filter(F.year("dtime_local") == year)
            day = F.date_from_unix_date(F.floor(F.unix_seconds("dtime") / 86_400).cast("int")).cast("string")
            records.select("line", "dtime", day.alias("day"), *POSITION).write.partitionBy("day").parquet(staging)
            days = sorted(n.removeprefix("day=") for n in child_names(spark, staging) if n.startswith("day="))
            if days:
                new = spark.read.schema(records.select("line", "dtime", *POSITION, F.lit("").alias("day")).schema).parquet(staging)
                old = good_records(parse_logs(self.lines(spark, days), self.log_format), mode)
                old = old.select("line", "dtime", *POSITION, day.alias("day"))
                both = old.withColumn("late", F.lit(0)).unionByName(new.withColumn("late", F.lit(1)))
                place = F.struct("late", *POSITION)
                merged = both.groupBy("line").agg(F.min("dtime").alias("dtime"), F.min("day").alias("day"), F.min(place).alias("place"))
                self.journal.stage_folders(merged.orderBy("day", "dtime", "place"), "log", "day")
        drop_path(spark, staging)
        return days

    def merge(self, spark: SparkSession, paths: str | Sequence[str], year: int | None = None, mode: str = "failfast") -> list[str]:
        """Merge new files into the log; returns the days that were replaced. Merging a file again changes nothing.

        Of lines of one instant those that are in the log come before new ones, and these keep the order of their files.
        """
        days = self.stage(spark, paths, year, mode)
        self.journal.finish(spark)
        return days
