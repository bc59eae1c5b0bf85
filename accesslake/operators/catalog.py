"""Keeping the file catalog in step with an object listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.functions.ids import surrogate_id
from accesslake.operators.joins import anti_join, semi_join

HASH = "hash"
KEEP = "keep"
TOUCH_MTIME = "touch_mtime"


def _hashed() -> Column:
    return F.col("sha2_256").isNotNull() & F.col("sha3_256").isNotNull()


def hashed_under_prefix(catalog: DataFrame, prefix: str = "") -> DataFrame:
    """Catalog rows below a key prefix that have both digests; all three tests reach the file scan."""
    rows = catalog.filter(_hashed())
    return rows.filter(F.col("s3key").startswith(prefix)) if prefix else rows


def plan_hashing(listing: DataFrame, catalog: DataFrame, prefix: str = "") -> DataFrame:
    """Listing rows with the ``action`` each needs.

    ``hash``: no hashed catalog row of equal ETag; ``touch_mtime``: hashed, same ETag, other mtime;
    ``keep``: nothing to do. ETags are compared with their quotes, as both sides store them.
    """
    known = hashed_under_prefix(catalog, prefix).select(
        "s3key", F.col("etag").alias("_etag"), F.col("mtime").alias("_mtime")
    )
    listed = listing.filter(F.col("s3key").startswith(prefix)) if prefix else listing
    same = F.coalesce(F.col("etag") == F.col("_etag"), F.lit(False))
    action = (
        F.when(~same, F.lit(HASH))
        .when(F.col("mtime").eqNullSafe(F.col("_mtime")), F.lit(KEEP))
        .otherwise(F.lit(TOUCH_MTIME))
    )
    return listed.join(known, "s3key", "left").withColumn("action", action).drop("_etag", "_mtime")


def refresh_mtime(catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """Catalog with the listing's mtime on the rows planned as ``touch_mtime``."""
    touched = plan.filter(F.col("action") == TOUCH_MTIME).select("s3key", F.col("mtime").alias("_mtime"))
    columns = [
        F.coalesce("_mtime", "mtime").alias("mtime") if c == "mtime" else F.col(c) for c in catalog.columns
    ]
    return catalog.join(touched, "s3key", "left").select(*columns)


def register_objects(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listing rows with ``outcome``: ``insert`` (new key), ``skip`` (same ETag, hashed), ``rehash``."""
    known = catalog.select(
        "s3key", F.lit(True).alias("_known"), F.col("etag").alias("_etag"), _hashed().alias("_hashed")
    )
    outcome = (
        F.when(F.col("_known").isNull(), F.lit("insert"))
        .when(F.col("_hashed") & (F.col("etag") == F.col("_etag")), F.lit("skip"))
        .otherwise(F.lit("rehash"))
    )
    return listing.join(known, "s3key", "left").withColumn("outcome", outcome).drop("_known", "_etag", "_hashed")


def new_catalog_rows(registered: DataFrame) -> DataFrame:
    """Catalog rows for the objects registered as ``insert``."""
    return registered.filter(F.col("outcome") == "insert").select(
        surrogate_id(F.col("s3key")).alias("id"),
        "s3key",
        F.current_timestamp().alias("modified"),
        "bytes",
        "mtime",
        F.lit(None).cast("string").alias("tags"),
        "etag",
        F.lit(None).cast("string").alias("sha2_256"),
        F.lit(None).cast("string").alias("sha3_256"),
        F.lit(True).alias("present"),
    )


def apply_hashes(catalog: DataFrame, hashed: DataFrame) -> DataFrame:
    """Catalog with etag, mtime, bytes and both digests taken from ``hashed`` for the keys in it."""
    fields = ("etag", "mtime", "bytes", "sha2_256", "sha3_256")
    updates = hashed.select("s3key", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in fields])
    columns = [
        F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in catalog.columns
    ]
    return catalog.join(updates, "s3key", "left").select(*columns)


def gc_missing(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Keys listed but not in the catalog."""
    return anti_join(listing.select("s3key"), catalog, ["s3key"], unique=True)


def gc_vanished(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog rows whose key is not listed any more."""
    return anti_join(catalog, listing, ["s3key"], unique=True)


def _downloaded(facts: DataFrame) -> DataFrame:
    return facts.select(F.col("did").alias("id"))


def gc_deletable(listing: DataFrame, catalog: DataFrame, facts: DataFrame) -> DataFrame:
    """Vanished rows nobody downloaded; they are removed."""
    return anti_join(gc_vanished(listing, catalog), _downloaded(facts), ["id"])


def gc_absent(listing: DataFrame, catalog: DataFrame, facts: DataFrame) -> DataFrame:
    """Vanished rows with downloads; they stay, marked as not present."""
    return semi_join(gc_vanished(listing, catalog), _downloaded(facts), ["id"])


def _gc_status(listing: DataFrame, catalog: DataFrame, facts: DataFrame) -> DataFrame:
    listed = listing.select("s3key").distinct().withColumn("_listed", F.lit(True))
    downloaded = _downloaded(facts).distinct().withColumn("_downloaded", F.lit(True))
    return catalog.join(listed, "s3key", "left").join(downloaded, "id", "left")


def gc_apply(listing: DataFrame, catalog: DataFrame, facts: DataFrame, revive: bool = False) -> DataFrame:
    """The catalog after collection: deletable rows gone, vanished but downloaded rows not present.

    ``revive`` also marks a listed row as present again.
    """
    gone = F.col("_listed").isNull()
    present = F.when(gone, F.lit(False))
    if revive:
        present = present.when(~gone, F.lit(True))
    present = present.otherwise(F.col("present"))
    return (
        _gc_status(listing, catalog, facts)
        .filter(~(gone & F.col("_downloaded").isNull()))
        .withColumn("present", present)
        .select(*catalog.columns)
    )


def gc_report(listing: DataFrame, catalog: DataFrame, facts: DataFrame) -> DataFrame:
    """One row with the counts of a collection."""
    listed = listing.groupBy("s3key").agg(F.count(F.lit(1)).alias("_entries"))
    downloaded = _downloaded(facts).distinct().withColumn("_downloaded", F.lit(True))
    known = catalog.select("s3key", "id", F.lit(True).alias("_known")).join(downloaded, "id", "left")
    status = known.join(listed, "s3key", "full_outer")
    vanished = F.col("_known").isNotNull() & F.col("_entries").isNull()
    used = F.col("_downloaded").isNotNull()
    return status.agg(
        F.count_if(F.col("_known").isNotNull()).alias("n_catalog"),
        F.coalesce(F.sum("_entries"), F.lit(0)).alias("n_listed"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_entries"))), F.lit(0)).alias("n_missing"),
        F.count_if(vanished).alias("n_vanished"),
        F.count_if(vanished & used).alias("n_downloaded"),
        F.count_if(vanished & ~used).alias("n_not_downloaded"),
        F.count_if(vanished & ~used).alias("n_deleted"),
        F.count_if(vanished & used).alias("n_kept"),
    )
