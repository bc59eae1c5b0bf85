"""Take in log files once each, and delete them when their rows are safe."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.sources.ledger import FILE, FileLedger, changed_files, delete_files
from accesslake.sources.listing import list_objects
from accesslake.sources.logs import read_lines
from accesslake.streaming.ingest import Landing, land_batch

#: Files of a batch; their names are what the driver has to hold.
BATCH_FILES = 10_000
#: Batches in the ledger before they are folded.
FOLDED_BATCHES = 64


def file_ledger(landing: Landing) -> FileLedger:
    """The ledger of a landing zone; they belong together, as a stream's checkpoint and its landing zone do."""
    return FileLedger(f"{landing.root}/ledger")


def log_files(spark: SparkSession, path: str, skip_hidden: bool = False) -> DataFrame:
    """Listing of the log files with content below a folder.

    Spark cannot read files below or with names that start with a dot or an underscore; such a file is an error
    that names it, unless ``skip_hidden``. They are looked for in the tasks that list. The checksum files that Hadoop's local
    file system keeps are no logs.
    """
    listed = list_objects(spark, path).filter("bytes > 0").filter(~F.col("s3key").rlike(r"(^|/)\.[^/]*\.crc$"))
    hidden = F.exists(F.split("s3key", "/"), lambda n: F.substring(n, 1, 1).isin(".", "_") & ~F.contains(n, F.lit("=")))
    if not skip_hidden:
        found = [r.uri for r in listed.filter(hidden).select("uri").limit(20).collect()]
        if found:
            raise ValueError(f"Spark would pass over these files; rename them or pass skip_hidden=True: {found}")
    return listed.filter(~hidden)


def _take_in(ledger: FileLedger, batch: int, land: Callable[[DataFrame], None], spark: SparkSession) -> list[str]:
    """Land one planned batch; if files have changed, they are returned and the batch is planned anew without them."""
    files = ledger.files(spark, batch)
    changed = changed_files(files)
    if not changed:
        names = [re.sub(r"([\[\]{}*?])", r"\\\1", r.uri) for r in files.select("uri").collect()]
        land(read_lines(spark, names))
        changed = changed_files(files)
    if changed:
        rows = files.filter(~F.col("uri").isin(changed)).collect()  # whole before the plan is overwritten; at most a batch's files
        ledger.replan(batch, spark.createDataFrame(rows, FILE))
    return changed


def consume_logs(
    spark: SparkSession,
    path: str,
    landing: Landing,
    log_format: str,
    ignored: DataFrame | None = None,
    mode: str = "quarantine",
    delete: bool = True,
    most: int = BATCH_FILES,
    skip_hidden: bool = False,
    batches: int | None = None,
) -> int:
    """Land the files below ``path`` that have not been taken in yet; returns how many batches were.

    A batch's files are planned before they are read and committed after their rows are stored. A run that is cut off
    before the commit is done again by the next one, into the same folders and with the same files; one that is cut off
    after it has its files in the ledger, and they are not read again. Files are deleted from the ledger only,
    when a batch has been committed, at the latest by the next run. A file that changes while it is read is left to a
    later run. ``publish_landing`` brings what has landed into a store; ``batches`` stops after so many.
    """
    ledger, done = file_ledger(landing), 0
    ledger.compact(spark, FOLDED_BATCHES)
    batch, busy = ledger.open_batch(spark), []
    while True:
        if batch is None:
            listing = log_files(spark, path, skip_hidden)
            if delete:
                delete_files(ledger.deletable(listing))
            if done == batches:
                return done
            batch = ledger.plan(listing.filter(~F.col("uri").isin(busy)), most)
            if batch is None:
                return done
        number = batch
        changed = _take_in(ledger, batch, lambda rows: land_batch(rows, number, landing, log_format, ignored, mode), spark)
        busy += changed
        if not changed:
            ledger.commit(spark, batch)
            done += 1
        batch = ledger.open_batch(spark)
