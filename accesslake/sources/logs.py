"""Reading and writing log text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.functions import text
from accesslake.sources.listing import hidden_files
from accesslake.sources.tables import existing_paths


def _line_columns() -> list:
    return [
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    ]


def scan_logs(spark: SparkSession, paths: str | Sequence[str], skip_hidden: bool = False) -> DataFrame:
    """Lines of files and whole directory trees, each with its position.

    Every file is taken, whatever its suffix; compressed ones are unpacked by suffix, and paths that
    name nothing are passed over. Spark cannot read files whose names start with a dot or an
    underscore; where such a file has content this is an error that names it, unless ``skip_hidden``. ``row_id`` grows along a split, so (file_path, file_block_start,
    row_id) is the order of the input.
    """
    found = existing_paths(spark, [paths] if isinstance(paths, str) else list(paths))
    if not found:
        return spark.createDataFrame([], "line string, file_path string, file_block_start bigint, row_id bigint")
    if not skip_hidden and (hidden := hidden_files(spark, found)):
        raise ValueError(f"Spark would pass over these files; rename them or pass skip_hidden=True: {hidden}")
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(found)
        .select(*_line_columns(), F.monotonically_increasing_id().alias("row_id"))
    )


def read_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines of files that are known by name, as ``scan_logs`` gives them."""
    return spark.read.text(list(files)).select(*_line_columns(), F.monotonically_increasing_id().alias("row_id"))


def stream_logs(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = 1000,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Lines of files as they arrive below ``path``, at most so many files per micro-batch.

    ``clean_source`` is ``archive`` or ``delete``. Cleaning up lags behind; what has been read is
    known from the query's checkpoint, not from the files left.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.text(path).select(*_line_columns())


def read_ignored_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys to ignore, one per line."""
    return spark.read.text(path).select(text.strip(F.col("value")).alias("key")).distinct()


def write_merged(records: DataFrame, path: str, compression: str = "none") -> None:
    """The original lines as text, in the order of the records.

    The sort is global: part files in name order, one after another, are the merged log.
    """
    records.select("line").write.mode("overwrite").option("compression", compression).text(path)


def with_archive_year(records: DataFrame) -> DataFrame:
    """Line and the year it is archived under, which is the record's own."""
    return records.select(F.year("dtime_local").alias("year"), "line")


def archive_lines(records: DataFrame, path: str) -> None:
    """Append raw lines below ``path/year=N``."""
    with_archive_year(records).write.partitionBy("year").mode("append").text(path)
