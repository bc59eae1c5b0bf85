"""Listings whose work is shared by tasks, and catalogs and listings joined as they lie in their buckets."""

import os

import pytest
from pyspark.sql import functions as F

from accesslake.operators import catalog as C
from accesslake.plans.sync import CatalogSync
from accesslake.sources import listing as L
from accesslake.sources import tables
from accesslake.sources.bucketed import BucketedTable
from accesslake.sources.logs import scan_logs

CATALOG_DDL = "s3key string, etag string, mtime timestamp, sha2_256 string, sha3_256 string"


def flat_folder(root, n):
    os.makedirs(root)
    for i in range(n):
        with open(f"{root}/o{i}", "wb") as f:
            f.write(b"x" * (i % 7))


def test_flat_folder_is_shared_by_tasks(spark, tmp_path, plan):
    flat_folder(tmp_path / "flat", 3000)
    os.symlink(tmp_path / "nowhere", tmp_path / "flat" / "broken")
    listed = L.list_objects(spark, str(tmp_path / "flat"))
    assert {(r.s3key, r.bytes) for r in listed.collect()} == {(f"o{i}", i % 7) for i in range(3000)}
    assert listed.select(F.input_file_name().alias("f")).distinct().count() > 1  # a file for each task that looked names up
    assert "Python" not in plan(listed) and "MapInArrow" not in plan(listed)  # looked up once, whoever reads it
    assert listed.filter("mtime is null or etag is null").count() == 0


def test_limit_looks_up_no_more_than_it_returns(spark, tmp_path, monkeypatch):
    flat_folder(tmp_path / "flat", 50)
    asked = []
    described = L.described
    monkeypatch.setattr(L, "described", lambda files: asked.append(files.count()) or described(files))
    assert L.list_objects(spark, str(tmp_path / "flat"), limit=7).count() == 7 and asked == [7]


def test_hidden_files_of_large_trees_are_found_in_tasks(spark, tmp_path, monkeypatch):
    flat_folder(tmp_path / "logs" / "_year=1" / "day=_2", 30)  # folders of partitions are no hidden ones
    (tmp_path / "logs" / ".empty").write_text("")
    monkeypatch.setattr(L, "DRIVER_ENTRIES", 5)
    assert scan_logs(spark, str(tmp_path / "logs")).count() > 0
    for place in ("logs/_year=1/.x", "logs/_folder/plain"):
        (tmp_path / place).parent.mkdir(exist_ok=True)
        (tmp_path / place).write_text("a\n")
    in_tasks = L.hidden_files(spark, [str(tmp_path / "logs")])
    monkeypatch.setattr(L, "DRIVER_ENTRIES", 10_000)
    on_driver = L.hidden_files(spark, [str(tmp_path / "logs")])
    ends = lambda found: sorted(f.split("/logs/")[1] for f in found)
    assert ends(in_tasks) == ends(on_driver) == ["_folder/plain", "_year=1/.x"]
    with pytest.raises(ValueError, match="plain"):
        scan_logs(spark, str(tmp_path / "logs"))


@pytest.fixture
def both(spark, tmp_path):
    """200 keys on either side, 100 of them on both, in buckets."""
    keys = spark.range(300).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("s3key"), "id")
    when = F.lit("2024-01-01").cast("timestamp").alias("mtime")
    known = keys.filter("id < 200").select(
        "s3key", F.lit('"e"').alias("etag"), when, F.when(F.col("id") % 2 == 0, F.lit("a")).alias("sha2_256"), F.lit("b").alias("sha3_256")
    )
    listed = keys.filter("id >= 100").select("s3key", F.when(F.col("id") < 150, F.lit('"e"')).otherwise(F.lit('"f"')).alias("etag"), when, F.col("id").alias("bytes"))
    sync = CatalogSync(str(tmp_path / "sync"), 8)
    sync.put_catalog(known)
    sync.put_listing(listed)
    yield sync, known, listed
    sync.catalogs.drop(spark)
    sync.listings.drop(spark)


def test_bucketed_plans_have_no_exchange(spark, both, plan):
    sync, known, listed = both
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        catalog, listing = sync.both(spark, known.schema, listed.schema)
        for result, plain in (
            (C.plan_hashing(listing, catalog), C.plan_hashing(listed, known)),
            (C.register_objects(listing, catalog), C.register_objects(listed, known)),
            (C.gc_missing(listing, catalog), C.gc_missing(listed, known)),
            (C.gc_vanished(listing, catalog), C.gc_vanished(listed, known)),
        ):
            assert "SortMergeJoin" in plan(result) and "Exchange" not in plan(result) and "Sort [" not in plan(result)
            assert sorted(map(str, result.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_versions_outlive_the_session_catalog(spark, both):
    sync, known, listed = both
    table = sync.catalogs
    files = [f for f in os.listdir(f"{table.path}/v1") if f.endswith(".parquet")]
    assert 0 < len(files) <= 8  # one for each bucket that has a key
    table.write(table.read(spark, known.schema).filter("s3key <> 'k0'"))  # computed from the version before
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]:
        spark.sql(f"drop table {name}")  # as in a later session; the files stay
    assert table.read(spark, known.schema).count() == 199
    assert tables.current_version(spark, table.path) == 2


def test_empty_and_unmade_tables(spark, tmp_path):
    table = BucketedTable(f"{tmp_path}/it's", "s3key", 4)
    empty = spark.createDataFrame([], CATALOG_DDL)
    assert table.read(spark, empty.schema).count() == 0
    assert table.write(empty).count() == 0
    table.drop(spark)
