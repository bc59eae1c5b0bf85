"""De-duplicate, filter and merge-sort log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.operators.classify import nonblank_lines
from accesslake.operators.parse import good_records, parse_logs

POSITION = ("file_path", "file_block_start", "row_id")


def dedup_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line, at its first position where lines carry one; ``n`` counts its copies.

    Copies are folded before the shuffle, so a line that makes up a third of the input crosses it
    once per input split.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    if set(POSITION) <= set(lines.columns):
        aggs.append(F.min(F.struct(*POSITION)).alias("position"))
    return lines.groupBy("line").agg(*aggs)


def distinct_records(
    lines: DataFrame, log_format: str, year: int | None = None, mode: str = "failfast"
) -> DataFrame:
    """Distinct parsed lines with ``dtime``, copies ``n``, and whether they are ``kept`` by the year filter."""
    parsed = good_records(parse_logs(dedup_lines(nonblank_lines(lines)), log_format), mode)
    kept = F.lit(True) if year is None else F.year("dtime_local") == year
    return parsed.withColumn("kept", kept)


def sort_records(distinct: DataFrame) -> DataFrame:
    """Kept records in time order.

    Ties are put in input order where lines carry their position, else in line order, so the result
    has one order whatever the partitioning. Lines are distinct by then: an instant shared by very
    many records still spreads over sort partitions.
    """
    tie = "position" if "position" in distinct.columns else "line"
    return distinct.filter("kept").drop("kept").orderBy("dtime", tie)


def report_records(distinct: DataFrame) -> DataFrame:
    """One row: lines read, copies dropped, lines filtered by year, time range, lines written.

    ``total_read`` counts written lines and copies; lines of other years are not in it.
    """
    dups = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return distinct.agg(
        (F.count_if("kept") + dups).alias("total_read"),
        dups.alias("dups"),
        F.count_if(~F.col("kept")).alias("filtered"),
        F.min(F.when(F.col("kept"), F.col("dtime"))).alias("earliest"),
        F.max(F.when(F.col("kept"), F.col("dtime"))).alias("latest"),
        F.count_if("kept").alias("written"),
    )


def merge_records(
    lines: DataFrame, log_format: str, year: int | None = None, mode: str = "failfast"
) -> DataFrame:
    """Distinct, parsed, year-filtered records in time order."""
    return sort_records(distinct_records(lines, log_format, year, mode))


def merge_report(
    lines: DataFrame, log_format: str, year: int | None = None, mode: str = "failfast"
) -> DataFrame:
    """The report of a merge, without the merge."""
    return report_records(distinct_records(lines, log_format, year, mode))
