import hashlib
import os
from datetime import datetime

from pyspark.sql import functions as F

from accesslake.operators import catalog as C
from accesslake.operators import hashing as H
from accesslake.sources.listing import list_objects, split_object_url

CATALOG = "id string, s3key string, modified timestamp, bytes bigint, mtime timestamp, tags string, etag string, sha2_256 string, sha3_256 string, present boolean"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 2)


def catalog(spark, *rows):
    return spark.createDataFrame([(k, k, T1, 1, T1, None, e, h, h, True) for k, e, h in rows], CATALOG)


def listing(spark, *rows):
    return spark.createDataFrame(list(rows), "s3key string, etag string, mtime timestamp, bytes bigint")


def fixture(spark):
    known = catalog(spark, ("p/same", '"1"', "h"), ("p/touched", '"2"', "h"), ("p/changed", '"3"', "h"), ("p/unhashed", '"4"', None), ("q/other", '"5"', "h"), ("p/noetag", None, "h"), ("p/gone", '"6"', "h"))
    listed = listing(spark, ("p/same", '"1"', T1, 1), ("p/touched", '"2"', T2, 1), ("p/changed", '"33"', T2, 9), ("p/unhashed", '"4"', T1, 1), ("p/new", '"7"', T1, 1), ("q/other", '"5"', T1, 1), ("p/noetag", '"8"', T1, 1))
    return known, listed


def test_hash_plan(spark, plan):
    known, listed = fixture(spark)
    got = {r.s3key: r.action for r in C.plan_hashing(listed, known).collect()}
    assert got == {"p/same": "keep", "p/touched": "touch_mtime", "p/changed": "hash", "p/unhashed": "hash", "p/new": "hash", "q/other": "keep", "p/noetag": "hash"}
    assert "q/other" not in {r.s3key for r in C.plan_hashing(listed, known, "p/").collect()}
    assert {r.s3key for r in C.hashed_under_prefix(known, "q/").collect()} == {"q/other"}


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    catalog(spark, ("p/a_b%", '"1"', "h")).write.parquet(f"{tmp_path}/c")
    df = C.hashed_under_prefix(spark.read.parquet(f"{tmp_path}/c"), "p/a_")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(s3key,p/a_)" in text and "IsNotNull(sha3_256)" in text
    assert df.count() == 1 and C.hashed_under_prefix(df, "p/a%").count() == 0


def test_register_refresh_apply(spark):
    known, listed = fixture(spark)
    registered = C.register_objects(listed, known)
    assert {r.s3key: r.outcome for r in registered.collect()} == {
        "p/same": "skip", "p/touched": "skip", "p/changed": "rehash", "p/unhashed": "rehash", "p/new": "insert", "q/other": "skip", "p/noetag": "rehash",
    }
    new = C.new_catalog_rows(registered)
    assert [(r.s3key, r.etag, r.present) for r in new.collect()] == [("p/new", '"7"', True)]
    assert set(new.columns) == set(known.columns)
    fresh = C.refresh_mtime(known, C.plan_hashing(listed, known))
    assert {r.s3key for r in fresh.filter(F.col("mtime") == T2).collect()} == {"p/touched"}
    hashed = spark.createDataFrame([("p/changed", '"33"', T2, 9, "n2", "n3")], "s3key string, etag string, mtime timestamp, bytes bigint, sha2_256 string, sha3_256 string")
    done = C.apply_hashes(known, hashed)
    assert done.columns == known.columns and done.count() == known.count()
    row = done.filter("s3key = 'p/changed'").first()
    assert (row.etag, row.mtime, row.bytes, row.sha2_256, row.sha3_256) == ('"33"', T2, 9, "n2", "n3")
    assert done.filter("s3key = 'p/same'").first().sha2_256 == "h"


def test_garbage_collection(spark):
    known = catalog(spark, *[(k, '"1"', "h") for k in ("here", "used", "unused")])
    listed = listing(spark, ("here", '"1"', T1, 1), ("new", '"1"', T1, 1))
    facts = spark.createDataFrame([("used",), ("used",), ("here",), ("else",)], "did string")
    assert [r.s3key for r in C.gc_missing(listed, known).collect()] == ["new"]
    assert {r.s3key for r in C.gc_vanished(listed, known).collect()} == {"used", "unused"}
    assert [r.s3key for r in C.gc_deletable(listed, known, facts).collect()] == ["unused"]
    assert [r.s3key for r in C.gc_absent(listed, known, facts).collect()] == ["used"]
    after = C.gc_apply(listed, known, facts)
    assert {(r.s3key, r.present) for r in after.collect()} == {("here", True), ("used", False)}
    report = C.gc_report(listed, known, facts).first().asDict()
    assert report == dict(n_catalog=3, n_listed=2, n_missing=1, n_vanished=2, n_downloaded=1, n_not_downloaded=1, n_deleted=1, n_kept=1)
    back = listing(spark, ("here", '"1"', T1, 1), ("used", '"1"', T1, 1))
    assert {r.present for r in C.gc_apply(back, after, facts).collect()} == {True, False}
    assert {r.present for r in C.gc_apply(back, after, facts, revive=True).collect()} == {True}
    assert C.gc_apply(listed, known, facts.limit(0)).count() == 1
    assert C.gc_deletable(known.select("s3key"), known, facts).count() == 0


def objects_on_disk(root):
    data = {"a/one.txt": b"hello world\n", "a b/two two.bin": os.urandom(200_001), "empty": b"", "_hidden": b"h", "deep/x/y": b"z" * 65_536}
    for key, content in data.items():
        path = os.path.join(root, key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)
    return data


def test_listing(spark, tmp_path):
    data = objects_on_disk(f"{tmp_path}/store")
    got = list_objects(spark, f"{tmp_path}/store")
    assert {(r.s3key, r.bytes) for r in got.collect()} == {(k, len(v)) for k, v in data.items()}
    assert [r.s3key for r in list_objects(spark, f"{tmp_path}/store", "a/").collect()] == ["a/one.txt"]
    assert [r.s3key for r in list_objects(spark, f"{tmp_path}/store", "deep/x").collect()] == ["deep/x/y"]
    assert [r.s3key for r in list_objects(spark, f"{tmp_path}/store", "deep/x/y").collect()] == ["deep/x/y"]
    assert list_objects(spark, f"{tmp_path}/store", "de/").count() == 0
    assert list_objects(spark, f"{tmp_path}/store", limit=2).count() == 2
    assert "content" not in got.columns
    assert split_object_url("s3://bucket/some/prefix/") == ("bucket", "some/prefix/")


def test_hash_objects(spark, tmp_path):
    data = objects_on_disk(f"{tmp_path}/store")
    listed = list_objects(spark, f"{tmp_path}/store")
    wrong = listed.filter("s3key = 'a/one.txt'").select(F.lit("w").alias("s3key"), "uri", "etag", "mtime", F.lit(5).cast("bigint").alias("bytes"))
    lost = listed.filter("s3key = 'empty'").select(F.lit("l").alias("s3key"), F.concat("uri", F.lit("-no")).alias("uri"), "etag", "mtime", "bytes")
    for task_bytes in (1 << 30, 1000):
        rows = H.hash_objects(listed.unionByName(wrong).unionByName(lost), task_bytes)
        good = {r.s3key: r for r in H.hash_good(rows).collect()}
        assert {k: (r.bytes, r.sha2_256, r.sha3_256) for k, r in good.items()} == {
            k: (len(v), hashlib.sha256(v).hexdigest(), hashlib.sha3_256(v).hexdigest()) for k, v in data.items()
        }
        assert {(r.s3key, r.error) for r in H.hash_rejects(rows).collect()} == {("w", "length differs"), ("l", "not found")}
    stats = H.hash_throughput(rows).first()
    assert (stats.n_objects, stats.bytes) == (5, sum(map(len, data.values()))) and stats.mb_per_second > 0
    assert H.hash_objects(listed.limit(0)).count() == 0
