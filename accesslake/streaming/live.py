"""Live views over a stream of log records: distinct lines, daily sums, class counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accesslake.functions.ids import surrogate_id
from accesslake.sources.tables import child_names, current_version, drop_path

SALTS = 64


def dedup_stream(records: DataFrame, delay: str | None = None, salts: int = SALTS) -> DataFrame:
    """First record of each line, whatever the order of files and the borders of micro-batches.

    Two stages. The first drops copies per line and input split, so the copies of one line are spread
    over tasks instead of meeting in one; the second drops what is left, at most one per salt. State
    is a 128-bit digest of each line and grows with the distinct lines. A caller who can bound how late
    lines are may pass ``delay``: state is then forgotten, and lines later than that are dropped.
    """
    split = F.xxhash64("file_path", "file_block_start")
    digest = F.unhex(F.substring(F.sha2("line", 256), 1, 32))
    keyed = records.withColumns({"_salt": F.pmod(split, F.lit(salts)), "_digest": digest})
    if delay is None:
        once = keyed.dropDuplicates(["_digest", "_salt"]).dropDuplicates(["_digest"])
    else:
        late = keyed.withWatermark("dtime", delay)
        once = late.dropDuplicatesWithinWatermark(["_digest", "_salt"]).dropDuplicatesWithinWatermark(["_digest"])
    return once.drop("_salt", "_digest")


def daily_sums(downloads: DataFrame, delay: str | None = None) -> DataFrame:
    """Running sums per file, address, agent and calendar day, for ``update`` mode.

    Every row is counted, however late: groups are kept. With ``delay`` groups are forgotten, and
    rows older than that are not in the view; the landed facts have them. Days are those of the
    wall clock, carried in a timestamp as watermarks need one.
    """
    wall = F.concat(F.col("dtime_local").cast("string"), F.lit("Z")).cast("timestamp")
    timed = lambda rows: rows if delay is None else rows.withWatermark("_wall", delay)
    rows = downloads.select("key", F.col("remote_ip").alias("remote_ipaddr"), "user_agent", "bytes_sent", wall.alias("_wall"))
    return (
        timed(rows)
        .groupBy(F.window("_wall", "1 day"), "key", "remote_ipaddr", "user_agent")
        .agg(F.sum("bytes_sent").alias("bytes_sent"))
        .select(
            F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86_400).cast("int")).alias("dt"),
            surrogate_id(F.col("key")).alias("did"),
            "key",
            "remote_ipaddr",
            "user_agent",
            "bytes_sent",
        )
    )


def class_counts_stream(classified: DataFrame) -> DataFrame:
    """Running counts per class, for ``update`` mode."""
    return classified.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def write_changes(
    view: DataFrame, path: str, checkpoint: str, mode: str = "update", available_now: bool = True
) -> StreamingQuery:
    """Write the rows each micro-batch changed below ``path/batch_id=N``.

    Changed groups are added, nothing is rewritten; a repeated batch replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = view.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, path)
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def folded_up_to(spark: SparkSession, path: str) -> int:
    """The first batch that ``compact_changes`` has not folded; 0 where it has folded none."""
    return current_version(spark, f"{path}_base") or 0


def latest_values(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """Current value per key, from the changes written by ``write_changes``.

    Changes that ``compact_changes`` has folded are read as one row per key, and only later batches' folders besides.
    """
    base, start = f"{path}_base", folded_up_to(spark, path)
    late = [f"{path}/batch_id={b}" for b in _batches(spark, path) if b >= start]
    if not late and not start:
        raise ValueError(f"no changes at {path}")
    parts = []
    if late:
        changes = spark.read.option("basePath", path).parquet(*late)
        parts.append(changes.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value), F.max("batch_id").alias("batch_id")))
    if start:
        parts.append(spark.read.parquet(f"{base}/v{start}"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def compact_changes(spark: SparkSession, path: str, keys: list[str], value: str, drop: bool = False) -> int:
    """Fold all changes so far into a base beside them; returns the first batch that is not in it.

    Run it while no batch is being written. With ``drop`` the folded batches are deleted; a view is then had from ``latest_values`` only.
    """
    batches, base, start = _batches(spark, path), f"{path}_base", folded_up_to(spark, path)
    version = batches[-1] + 1 if batches else 0
    if version > start:
        rows = latest_values(spark, path, keys, value).withColumn("batch_id", F.lit(version - 1).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{base}/v{version}")
    if drop:
        for batch in batches:
            if batch < version:
                drop_path(spark, f"{path}/batch_id={batch}")
    return max(version, start)
