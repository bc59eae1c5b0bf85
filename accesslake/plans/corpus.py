"""Keep a store's catalog in step with its objects: hash, collect garbage, copy between stores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.operators import catalog as C
from accesslake.operators.hashing import RESULT_DDL, TASK_BYTES, deal_by_size, hash_dealt, hash_good
from accesslake.operators.joins import semi_join
from accesslake.operators.star import missing_facts, resolve_facts
from accesslake.plans.store import Store
from accesslake.session import scratch_path, sized_shuffles
from accesslake.sources import tables


#: Tasks of a slice for each core: how often its cores wait for the last task.
SLICE_WAVES = 8
#: Slices of a hash job, as far as none gets more than SLICE_BYTES by that: a slice costs its own job however little it hashes.
MOST_SLICES, SLICE_BYTES = 32, 64 << 30


def hash_results(spark: SparkSession, store: Store) -> DataFrame:
    """What slices of an unfinished hash job have hashed."""
    root = f"{store.root}/hashed"
    whole = [n for n in tables.child_names(spark, root) if tables.path_exists(spark, f"{root}/{n}/_SUCCESS")]
    return spark.read.schema(RESULT_DDL).parquet(*[f"{root}/{n}" for n in whole]) if whole else spark.createDataFrame([], RESULT_DDL)


def hash_pending(
    spark: SparkSession, store: Store, wanted: DataFrame, task_bytes: int = TASK_BYTES, slices: int | None = None
) -> None:
    """Hash objects slice by slice; what an earlier run has hashed under the same ETag is left out.

    A slice counts when it is written whole. The rest of a job that is killed is hashed by the next one; ``slices`` stops after so many.
    A slice has SLICE_WAVES tasks a core. They take a slot each, or more where slots are so small that there would be more than
    MOST_SLICES slices; a killed job then loses one in MOST_SLICES, or SLICE_BYTES, at most.
    """
    root, done = f"{store.root}/hashed", hash_results(spark, store).select("s3key", "etag")
    staging = scratch_path(spark, "hash-dealt")
    dealt, slots = deal_by_size(wanted.join(done, ["s3key", "etag"], "left_anti"), task_bytes)
    dealt.orderBy("slot").write.parquet(staging)  # so that a slice reads its own part
    dealt = spark.read.parquet(staging)
    number = max([int(n.removeprefix("slice=")) for n in tables.child_names(spark, root) if n.startswith("slice=")], default=-1) + 1
    tasks = SLICE_WAVES * spark.sparkContext.defaultParallelism
    step = max(tasks, min(-(-slots // MOST_SLICES), SLICE_BYTES // task_bytes))
    for i, first in enumerate(range(0, 0 if dealt.isEmpty() else slots, step)):
        if i == slices:
            break
        hash_dealt(dealt, first, min(step, slots - first), tasks).write.mode("overwrite").parquet(f"{root}/slice={number + i}")
    tables.drop_path(spark, staging)


def hash_listing(
    spark: SparkSession, store: Store, listing: DataFrame, prefix: str = "", task_bytes: int = TASK_BYTES, slices: int | None = None
) -> DataFrame:
    """Hash what the listing has new or changed and bring the catalog up to date.

    Returns the result row of every object hashed, rejects included. Contents are read only for objects the plan says need it,
    and once: results are written below the store, slice by slice, before the catalog is, and a job that is killed is taken up
    by the next. With ``slices`` the job stops after so many, as a killed one does, and leaves the catalog.
    """
    store.recover(spark)
    catalog = store.catalog(spark)
    plan = C.plan_hashing(listing, catalog, prefix)
    hash_pending(spark, store, plan.filter(F.col("action") == C.HASH), task_bytes, slices)
    if slices is not None:
        return hash_results(spark, store)
    results_path = scratch_path(spark, "hash")
    wanted = plan.filter(F.col("action") == C.HASH).select("s3key", "etag")
    # an object that was hashed by two runs, because its ETag changed between them, counts as it is listed now
    semi_join(hash_results(spark, store), wanted, ["s3key", "etag"]).write.parquet(results_path)
    results = spark.read.schema(RESULT_DDL).parquet(results_path)

    added = C.new_catalog_rows(C.register_objects(listing.filter(F.col("s3key").startswith(prefix)), catalog))
    known = C.refresh_mtime(catalog, plan).unionByName(added.select(*catalog.columns))
    updated = C.apply_hashes(known, hash_good(results))
    keys = [plan.filter(F.col("action") == C.TOUCH_MTIME), added, results]
    changed = semi_join(updated, reduce(DataFrame.unionByName, [k.select("s3key") for k in keys]), ["s3key"])
    store.put_files(updated, changed)
    tables.drop_path(spark, f"{store.root}/hashed")
    return results


def collect_garbage(
    spark: SparkSession, store: Store, listing: DataFrame, revive: bool = False, allow_empty: bool = False
) -> DataFrame:
    """Drop vanished entries nobody downloaded, mark the others absent; returns the one-row report.

    An empty listing, which would drop them all, is refused unless it is allowed.
    """
    if not allow_empty and listing.isEmpty():
        raise ValueError("the listing is empty; pass allow_empty=True if every object is really gone")
    store.recover(spark)
    catalog, facts = store.catalog(spark), store.facts(spark)
    # the report's one row is computed before the catalog changes
    report = C.gc_report(listing, catalog, facts)
    report = spark.createDataFrame([report.first()], report.schema)
    with sized_shuffles(facts):
        updated = C.gc_apply(listing, catalog, facts, revive)
        before = catalog.select("s3key", F.col("present").alias("_before"))
        changed = updated.join(before, "s3key").filter(~F.col("present").eqNullSafe(F.col("_before"))).drop("_before")
        store.put_files(updated, changed, gone=C.gc_deletable(listing, catalog, facts))
    return report


def copy_downloads(spark: SparkSession, source: Store, target: Store) -> None:
    """Copy downloads the target store lacks."""
    source.recover(spark)
    target.recover(spark)
    catalog = target.catalog(spark)
    missing = missing_facts(source.facts(spark), source.catalog(spark), target.facts(spark), catalog)
    staging = scratch_path(spark, "copy")
    with sized_shuffles(source.facts(spark)):
        missing.write.parquet(staging)
    downloads = spark.read.parquet(staging).select(
        "*",
        F.lit(None).cast("string").alias("user_agent"),
        F.col("dtime_local").alias("dtime"),
    )
    target.add_files(spark, downloads)
    # ids are looked up, as the target's may come from elsewhere
    tables.append_facts(resolve_facts(downloads, target.catalog(spark), target.agents(spark)), target.facts_path)
    tables.drop_path(spark, staging)
