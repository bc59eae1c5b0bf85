"""Load saved log files into a store."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accesslake import schemas
from accesslake.operators.classify import drop_ignored_keys, nonblank_lines, record_class
from accesslake.operators.parse import good_records, normalize_keys, parse_logs
from accesslake.operators.star import fact_rows, resolve_facts
from accesslake.plans.store import Store
from accesslake.session import scratch_path, sized_shuffles
from accesslake.sources import tables
from accesslake.sources.logs import archive_lines

MALFORMED = "MALFORMED"
CLASSES = (
    schemas.DOWNLOAD, schemas.UPLOAD, schemas.BAD, schemas.DELETED, schemas.MISC, schemas.BLOCKED,
    schemas.UNKNOWN, MALFORMED,
)
LANDED = [
    "line", "dtime", "dtime_local", "remote_ip", "key", "object_size", "bytes_sent", "user_agent",
    "parse_error", "class",
]


def classified_lines(
    lines: DataFrame, log_format: str, ignored: DataFrame | None = None, mode: str = "quarantine"
) -> DataFrame:
    """Parsed and classified lines; malformed ones are the class ``MALFORMED``, or end the job."""
    parsed = parse_logs(nonblank_lines(lines), log_format)
    error = F.col("parse_error")
    if mode == "failfast":
        parsed = good_records(parsed, mode).withColumn("parse_error", F.lit(None).cast("string"))
    else:
        parsed = parsed.withColumn("key", F.when(error.isNull(), F.col("key")))
    if ignored is not None:
        parsed = drop_ignored_keys(parsed, ignored)
    label = record_class(F.col("operation"), F.col("http_status"))
    return parsed.withColumn("class", F.when(error.isNotNull(), F.lit(MALFORMED)).otherwise(label))


class IngestCounts(dict):
    """How many lines each class had, and the counters of an ingest.

    ``n_objects`` files were read, those without records included; it is None for lines that are from no files. Times
    are UTC, those of the first and last download.
    """

    def __init__(self, counts: dict, n_objects: int | None, span: tuple[int | None, int | None]):
        super().__init__(counts)
        self.n_objects = n_objects
        self.n_records = sum(n for c, n in counts.items() if c != MALFORMED)
        self.n_downloads = counts[schemas.DOWNLOAD]
        self.earliest, self.latest = [None if t is None else datetime.fromtimestamp(0, UTC) + timedelta(microseconds=t) for t in span]


def land(classified: DataFrame, path: str, partition_by: Sequence[str] = ("class",)) -> IngestCounts:
    """Write downloads and malformed lines; returns how many lines each class had, with the counters.

    The raw text is read and parsed in this pass only. The counts come out of the same pass, and
    everything else is derived from the columns written here.
    """
    seen = Observation()
    downloaded = F.when(F.col("class") == schemas.DOWNLOAD, F.unix_micros("dtime"))
    span = [F.min(downloaded).alias("_first"), F.max(downloaded).alias("_last")]
    observed = classified.observe(seen, *[F.count_if(F.col("class") == c).alias(c) for c in CLASSES], *span)
    wanted = observed.filter(F.col("class").isin(schemas.DOWNLOAD, MALFORMED))
    columns = [*LANDED, F.to_date("dtime_local").alias("dt")] if "dt" in partition_by else LANDED
    writer = wanted.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)
    found = seen.get
    ends = found.pop("_first"), found.pop("_last")
    return IngestCounts(found, len(classified.inputFiles()) if "file_path" in classified.columns else None, ends)


def ingest_files(
    spark: SparkSession,
    lines: DataFrame,
    log_format: str,
    store: Store,
    ignored: DataFrame | None = None,
    mode: str = "quarantine",
    normalize: bool = False,
    lookup: bool = False,
    collation: str | None = None,
) -> IngestCounts:
    """Append the downloads in ``lines`` to the store; returns the class counts and counters.

    ``normalize`` takes the leading slashes off keys, so that web and bucket logs of one file meet. With ``lookup`` ids are looked
    up in the store's dimensions, which may come from elsewhere. With a ``collation`` keys and agents that it holds
    equal are one, and ids are looked up; dimensions in key buckets tell keys apart by their bytes and do not take one.

    Facts come last, so an ingest that failed can be repeated without counting a download twice; only
    the archive and the error log may then hold lines twice. ``streaming.ingest.land_batch`` can be
    repeated without even that.
    """
    if collation and store.buckets:
        raise ValueError("dimensions in key buckets tell keys apart by their bytes; use snapshots with a collation")
    store.recover(spark)
    staging = scratch_path(spark, "ingest")
    classified = classified_lines(lines, log_format, ignored, mode)
    counts = land(normalize_keys(classified) if normalize else classified, staging)
    staged = spark.read.schema(landed_schema()).parquet(staging)
    downloads = staged.filter(F.col("class") == schemas.DOWNLOAD)

    archive_lines(downloads, store.archive_path)
    if counts[MALFORMED]:
        rejects = staged.filter(F.col("class") == MALFORMED).select("line", "parse_error")
        rejects.write.mode("append").parquet(store.malformed_path)
    with sized_shuffles(staged):
        store.add_files(spark, downloads, collation)
        store.add_agents(spark, downloads, collation)
        if lookup or collation:
            facts = resolve_facts(downloads, store.catalog(spark), store.agents(spark), collation)
        else:
            facts = fact_rows(downloads)
        tables.append_facts(facts, store.facts_path)
    tables.drop_path(spark, staging)
    return counts


def landed_schema(*more: str) -> str:
    """DDL of landed rows; partition columns may be added."""
    return ", ".join(
        [
            "line string, dtime timestamp, dtime_local timestamp_ntz, remote_ip string, key string",
            "object_size bigint, bytes_sent bigint, user_agent string, parse_error string, class string",
            *more,
        ]
    )


