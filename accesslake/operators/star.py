"""Loading downloads into the star schema: two dimensions and a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.functions.ids import surrogate_id
from accesslake.operators.joins import anti_join


def _name(c: str, collation: str | None) -> Column:
    return F.col(c) if collation is None else F.collate(F.col(c), collation)


def _not_in(fresh: DataFrame, existing: DataFrame, key: str, collation: str | None) -> DataFrame:
    if collation is None:
        return anti_join(fresh, existing, [key], unique=True)
    known = existing.select(_name(key, collation).alias("_known")).distinct()
    return fresh.join(known, _name(key, collation) == F.col("_known"), "left_anti")


def catalog_additions(downloads: DataFrame, catalog: DataFrame, collation: str | None = None) -> DataFrame:
    """Catalog rows for keys not there yet; the size seen first wins.

    Rows fold to one per (key, size) by a hash aggregate before any shuffle; only those few are then
    ordered by time. Sizes first seen at one instant are decided by value, NULL before numbers.
    Keys differ by their bytes; with a ``collation`` such as ``UNICODE_CI_AI`` those it holds equal are
    one, under the spelling seen first, and facts are then built by ``resolve_facts``.
    """
    sizes = downloads.groupBy("key", "object_size").agg(F.min("dtime").alias("first_seen"))
    first = (
        sizes.groupBy(_name("key", collation).alias("_name"))
        .agg(F.min(F.struct("first_seen", "key", "object_size")).alias("first"))
        .select(F.col("first.key").alias("s3key"), F.col("first.object_size").alias("bytes"))
    )
    return _not_in(first, catalog, "s3key", collation).select(
        surrogate_id(F.col("s3key")).alias("id"),
        "s3key",
        F.current_timestamp().alias("modified"),
        "bytes",
        F.lit(None).cast("timestamp").alias("mtime"),
        F.lit(None).cast("string").alias("tags"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("sha2_256"),
        F.lit(None).cast("string").alias("sha3_256"),
        F.lit(True).alias("present"),
    )


def agent_additions(downloads: DataFrame, agents: DataFrame, collation: str | None = None) -> DataFrame:
    """User-agent rows not there yet. NULL agents get none: an equality lookup never finds NULL."""
    seen = downloads.select("user_agent").filter(F.col("user_agent").isNotNull()).distinct()
    if collation is not None:
        spelled = seen.groupBy(_name("user_agent", collation).alias("_name"))
        seen = spelled.agg(F.min("user_agent").alias("user_agent")).select("user_agent")
    fresh = _not_in(seen, agents, "user_agent", collation)
    return fresh.select(surrogate_id(F.col("user_agent")).alias("id"), "user_agent")


def _fact_columns() -> list:
    return [
        F.col("remote_ip").alias("remote_ipaddr"),
        F.col("dtime_local").alias("dtime"),
        "bytes_sent",
        F.lit(False).alias("summary"),
        F.to_date("dtime_local").alias("dt"),
    ]


def fact_rows(downloads: DataFrame) -> DataFrame:
    """One fact per download. Ids are functions of the natural keys, so nothing is joined or shuffled."""
    return downloads.select(
        surrogate_id(F.col("key")).alias("did"),
        surrogate_id(F.col("user_agent")).alias("user_agent_id"),
        *_fact_columns(),
    )


def resolve_facts(
    downloads: DataFrame, catalog: DataFrame, agents: DataFrame, collation: str | None = None
) -> DataFrame:
    """One fact per download, ids looked up in dimension tables.

    For dimensions whose ids come from elsewhere, such as auto-increment columns of an imported
    store, and for keys that are equal under a collation. A dimension is small enough to broadcast or
    the join shuffles by key, and AQE then splits the partitions that hot keys and hot agents fill.
    """
    files = catalog.select(F.col("id").alias("did"), _name("s3key", collation).alias("_key"))
    named = agents.select(F.col("id").alias("user_agent_id"), _name("user_agent", collation).alias("_agent"))
    return (
        downloads.join(files, _name("key", collation) == F.col("_key"), "inner")
        .join(named, _name("user_agent", collation) == F.col("_agent"), "left")
        .select("did", "user_agent_id", *_fact_columns())
    )


def missing_facts(
    source_facts: DataFrame, source_catalog: DataFrame, target_facts: DataFrame, target_catalog: DataFrame
) -> DataFrame:
    """Downloads of one store that another lacks, as (key, object_size, remote_ip, dtime_local, bytes_sent).

    Two facts are the same when key, address and time are equal. A fact the source holds several
    times is copied once.
    """
    identity = ["key", "remote_ip", "dtime_local"]

    def natural(facts: DataFrame, catalog: DataFrame, *more: str) -> DataFrame:
        files = catalog.select(
            F.col("id").alias("did"), F.col("s3key").alias("key"), F.col("bytes").alias("object_size")
        )
        return facts.join(files, "did").select(
            "key", F.col("remote_ipaddr").alias("remote_ip"), F.col("dtime").alias("dtime_local"), *more
        )

    source = (
        natural(source_facts, source_catalog, "object_size", "bytes_sent")
        .filter(F.col("remote_ip").isNotNull() & F.col("dtime_local").isNotNull())
        .groupBy(*identity)
        .agg(F.max("object_size").alias("object_size"), F.max("bytes_sent").alias("bytes_sent"))
    )
    return anti_join(source, natural(target_facts, target_catalog), identity)


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``base`` with each update put in place of the row of equal key.

    Several updates of one key need ``order``: the highest wins.
    """
    if order is not None:
        columns = [c for c in base.columns if c != key]
        updates = updates.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_row"))
        updates = updates.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
    kept = base.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates.select(*base.columns))


def delete_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``base`` without the rows of the given keys."""
    return anti_join(base, keys, [key])
