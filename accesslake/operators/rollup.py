"""Roll-ups of download facts, and counts over records and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from accesslake.operators.joins import broadcast_if_small
from accesslake.session import scratch_path

GROUP = ("did", "remote_ipaddr", "user_agent_id", "dt")


def _in_range(first, last) -> Column:
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col("dt") >= F.lit(first).cast("date"))
    if last is not None:
        keep = keep & (F.col("dt") <= F.lit(last).cast("date"))
    return keep


def _sum_by_day(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(*GROUP)
        .agg(F.sum("bytes_sent").alias("bytes_sent"))
        .select(
            "did",
            "user_agent_id",
            "remote_ipaddr",
            F.col("dt").cast("timestamp_ntz").alias("dtime"),
            "bytes_sent",
            F.lit(True).alias("summary"),
            "dt",
        )
    )


def daily_rollup(facts: DataFrame, first=None, last=None) -> DataFrame:
    """Summary rows of the raw facts between two days, both inclusive.

    The range and the flag are filters on stored columns (``dt`` prunes partitions); sums are partial
    before the shuffle, so a file with a third of all downloads costs one row per group and task.
    """
    return _sum_by_day(facts.filter(_in_range(first, last) & ~F.col("summary")))


def summarize(facts: DataFrame, first=None, last=None, compact: bool = False) -> DataFrame:
    """Facts with the raw rows of the range replaced by summary rows.

    Existing summary rows stay and new ones join them; ``compact`` folds both into one per group.
    """
    within = _in_range(first, last)
    if compact:
        return facts.filter(~within).unionByName(_sum_by_day(facts.filter(within)))
    rest = facts.filter(~within | F.col("summary"))
    return rest.unionByName(daily_rollup(facts, first, last))


def rollup_savings(facts: DataFrame, first=None, last=None) -> DataFrame:
    """Per day: rows before, rows after, rows saved by ``summarize``."""
    groups = (
        facts.filter(_in_range(first, last))
        .groupBy(*GROUP)
        .agg(F.count_if(~F.col("summary")).alias("raw"), F.count_if("summary").alias("done"))
    )
    return groups.groupBy("dt").agg(
        F.sum(F.col("raw") + F.col("done")).alias("rows_before"),
        (F.sum("done") + F.count_if(F.col("raw") > 0)).alias("rows_after"),
        (F.sum("raw") - F.count_if(F.col("raw") > 0)).alias("saved"),
    )


def rollup_bounds(facts: DataFrame) -> DataFrame:
    """First and last day with raw rows; NULLs when there are none."""
    return facts.filter(~F.col("summary")).agg(F.min("dt").alias("first_day"), F.max("dt").alias("last_day"))


def year_range(year: int) -> tuple[str, str]:
    """First and last day of a year."""
    return f"{year}-01-01", f"{year}-12-31"


def year_rollover(facts: DataFrame) -> DataFrame:
    """Summary rows over raw and summary rows alike, for a new store."""
    return _sum_by_day(facts)


def store_stats(catalog: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: files in the catalog, facts, first and last download."""
    none = F.lit(None).cast("timestamp_ntz")
    both = catalog.select(F.lit(True).alias("file"), none.alias("dtime")).unionByName(
        facts.select(F.lit(False).alias("file"), "dtime")
    )
    return both.agg(
        F.count_if("file").alias("n_files"),
        F.count_if(~F.col("file")).alias("n_downloads"),
        F.min("dtime").alias("earliest"),
        F.max("dtime").alias("latest"),
    )


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def time_bounds(records: DataFrame) -> DataFrame:
    return records.agg(F.min("dtime").alias("earliest"), F.max("dtime").alias("latest"))


def dates_seen(records: DataFrame) -> DataFrame:
    return records.select(F.to_date("dtime_local").alias("day")).distinct()


def ingest_counters(classified: DataFrame, file_col: str = "file_path") -> DataFrame:
    """One row: files, records, downloads, first and last download."""
    download = F.col("class") == "DOWNLOAD"
    return classified.agg(
        F.count_distinct(file_col).alias("n_objects"),
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(download).alias("n_downloads"),
        F.min(F.when(download, F.col("dtime"))).alias("earliest"),
        F.max(F.when(download, F.col("dtime"))).alias("latest"),
    )


def listing_stats(listing: DataFrame) -> DataFrame:
    """One row: listed objects, first and last modification."""
    return listing.agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.min("mtime").alias("earliest"),
        F.max("mtime").alias("latest"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Scanned lines with ``line_index``, their 0-based number in the file.

    Row ids are consecutive within an input split, so an index is the row's distance from the
    split's first id plus the lines of the file's earlier splits. Only one row per split, some
    128 MB of log, is shuffled, windowed and written; it goes to the lines by broadcast while it is
    within 256 MB, which is above 100 TB of log, and the lines stay where they were read. The input is
    scanned twice; splits that differ, as they can when cores come and go, end the job.
    """
    split = ["file_path", "file_block_start"]
    counts = lines.groupBy(*split).agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("file_path").orderBy("file_block_start").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*split, "first_id", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    path = scratch_path(lines.sparkSession, "offsets")
    offsets.write.parquet(path)
    stored = lines.sparkSession.read.schema(offsets.schema).parquet(path)
    within = F.col("row_id") - F.col("first_id")
    changed = F.raise_error(F.lit("input splits changed between scans; set spark.sql.files.minPartitionNum"))
    index = F.when(within.between(0, F.col("n") - 1), within + F.col("offset")).otherwise(changed.cast("bigint"))
    return (
        lines.join(broadcast_if_small(stored, max_rows=2_000_000, max_bytes=256 << 20), split, "left")
        .withColumn("line_index", index)
        .drop("first_id", "offset", "n")
    )


def batch_bounds(numbered: DataFrame, size: int = 10_000) -> DataFrame:
    """First and last instant of every batch of about ``size`` lines of a file.

    ``numbered`` holds parsed non-blank lines. A batch closes on a record whose index is a multiple of
    ``size``, beyond 0; where that line is blank it runs on to the next multiple. Lines after the last
    close are not reported.
    """
    index = F.col("line_index")
    per_step = (
        numbered.withColumn("step", F.greatest(F.lit(1), F.ceil(index / F.lit(size))).cast("bigint"))
        .groupBy("file_path", "step")
        .agg(
            F.min("dtime").alias("earliest"),
            F.max("dtime").alias("latest"),
            F.max(index == F.col("step") * size).alias("closes"),
        )
    )
    # backwards, so that the frame only grows: the next close is the least one met so far
    ahead = W.partitionBy("file_path").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    closed = per_step.withColumn("batch", F.min(F.when(F.col("closes"), F.col("step"))).over(ahead))
    return (
        closed.filter(F.col("batch").isNotNull())
        .groupBy("file_path", (F.col("batch") * size).alias("processed"))
        .agg(F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))
    )
