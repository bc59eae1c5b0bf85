import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from accesslake.plans.corpus import collect_garbage, copy_downloads, hash_listing
from accesslake.plans.ingest import ingest_files
from accesslake.plans.store import Store
from accesslake.plans.summarize import roll_over, summarize_store
from accesslake.session import INITIAL_PARTITIONS_CONF, scratch_path, shared_dir, sized_shuffles
from accesslake.sources import tables
from accesslake.sources.listing import list_objects
from test_catalog import objects_on_disk


def log(lines, bucket):
    return lines(
        bucket(key="a", time="01/Jan/2024:05:00:00 +0000", sent="1", size="100"),
        bucket(key="a", time="01/Jan/2024:06:00:00 +0000", sent="2", size="200"),
        bucket(key="a", time="02/Jan/2024:06:00:00 +0000", sent="-", agent='"other"'),
        bucket(key="b", time="02/Jan/2024:07:00:00 +0000", sent="4"),
        bucket(key="skip%20me", time="02/Jan/2024:07:00:00 +0000"),
        bucket(key="b", op="REST.PUT.OBJECT"), bucket(key="b", status="404"), "", "junk",
    )


def test_ingest_and_summarize(spark, lines, bucket, tmp_path):
    store = Store(f"{tmp_path}/store")
    ignored = spark.createDataFrame([("skip me",)], "key string")
    counts = ingest_files(spark, log(lines, bucket), "bucket", store, ignored)
    assert {k: v for k, v in counts.items() if v} == {"DOWNLOAD": 4, "UPLOAD": 1, "BAD": 1, "MALFORMED": 1}
    assert {(r.s3key, r.bytes) for r in store.catalog(spark).collect()} == {("a", 100), ("b", 100)}
    assert {r.user_agent for r in store.agents(spark).collect()} == {"agent x", "other"}
    assert store.facts(spark).count() == 4
    assert spark.read.text(store.archive_path).count() == 4
    assert spark.read.parquet(store.malformed_path).first().line == "junk"

    ingest_files(spark, lines(bucket(key="a", size="999", time="01/Jan/2024:06:00:00 +0000", sent="2")), "bucket", store)
    assert store.catalog(spark).filter("s3key = 'a'").first().bytes == 100
    assert store.facts(spark).count() == 5

    assert summarize_store(spark, store, last="2024-01-01") == 2
    first = store.facts(spark).filter(F.col("dt") == date(2024, 1, 1)).collect()
    assert [(r.dtime, r.bytes_sent, r.summary) for r in first] == [(datetime(2024, 1, 1), 5, True)]
    assert store.facts(spark).filter("not summary").count() == 2
    assert summarize_store(spark, store, year=2024) == 0
    assert summarize_store(spark, store) == 0
    assert store.facts(spark).filter("not summary").count() == 0 and store.facts(spark).count() == 3
    with pytest.raises(ValueError):
        summarize_store(spark, store, first="2024-01-01", year=2024)

    ingest_files(spark, lines(bucket(key="a", time="01/Jan/2024:09:00:00 +0000", sent="7")), "bucket", store)
    assert summarize_store(spark, store) == 0
    assert store.facts(spark).filter(F.col("dt") == date(2024, 1, 1)).count() == 2
    assert summarize_store(spark, store, first="2024-01-01", last="2024-01-02", compact=True) >= 0
    assert sorted(r.bytes_sent or 0 for r in store.facts(spark).collect()) == [0, 4, 12]

    target = Store(f"{tmp_path}/year")
    roll_over(spark, store, target)
    assert target.facts(spark).count() == 3


def test_one_web_line_makes_one_file_and_one_fact(spark, lines, tmp_path):
    store = Store(f"{tmp_path}/store")
    line = '203.0.113.9 - - [31/Dec/2019:22:10:05 -0400] "GET /pkg/tool-9.2.zip  HTTP/1.1" 200 73500'
    counts = ingest_files(spark, lines(line), "web", store)
    assert {k: v for k, v in counts.items() if v} == {"DOWNLOAD": 1}
    assert [(r.s3key, r.bytes) for r in store.catalog(spark).collect()] == [("/pkg/tool-9.2.zip", 73500)]
    fact = store.facts(spark).first()
    assert (fact.dtime, fact.dt, fact.user_agent_id) == (datetime(2019, 12, 31, 22, 10, 5), date(2019, 12, 31), None)
    assert store.agents(spark).count() == 0
    assert [r.year for r in spark.read.text(store.archive_path).select("year").collect()] == [2019]


def test_an_ingest_without_downloads(spark, lines, bucket, tmp_path):
    store = Store(f"{tmp_path}/store")
    assert sum(ingest_files(spark, lines(""), "bucket", store).values()) == 0
    assert ingest_files(spark, lines(bucket(op="REST.PUT.OBJECT")), "bucket", store)["UPLOAD"] == 1
    assert summarize_store(spark, store) == 0
    assert ingest_files(spark, lines(bucket()), "bucket", store)["DOWNLOAD"] == 1
    assert store.facts(spark).count() == 1 and store.catalog(spark).count() == 1


def test_malformed_line_ends_a_failfast_ingest(spark, lines, bucket, tmp_path):
    store = Store(f"{tmp_path}/store")
    with pytest.raises(Exception, match="malformed log line"):
        ingest_files(spark, lines(bucket(), "junk"), "bucket", store, mode="failfast")
    short = " ".join(bucket(key="skip").split(" ")[:12])
    ignored = spark.createDataFrame([("skip",)], "key string")
    with pytest.raises(Exception, match="malformed log line"):
        ingest_files(spark, lines(bucket(), short), "bucket", store, ignored, mode="failfast")
    counts = ingest_files(spark, lines(bucket(key="skip"), short), "bucket", Store(f"{tmp_path}/other"), ignored)
    assert {k: v for k, v in counts.items() if v} == {"MALFORMED": 1}
    assert store.facts(spark).count() == 0


def test_corpus_upkeep(spark, lines, bucket, tmp_path):
    root, store = f"{tmp_path}/objects", Store(f"{tmp_path}/store")
    data = objects_on_disk(root)
    ingest_files(spark, lines(bucket(key="a/one.txt"), bucket(key="old/used"), bucket(key="empty")), "bucket", store)
    results = hash_listing(spark, store, list_objects(spark, root))
    assert results.count() == 5
    rows = {r.s3key: r for r in store.catalog(spark).collect()}
    assert set(rows) == set(data) | {"old/used"}
    assert all(rows[k].sha2_256 == hashlib.sha256(v).hexdigest() for k, v in data.items())
    assert all(rows[k].sha3_256 == hashlib.sha3_256(v).hexdigest() for k, v in data.items())
    assert rows["old/used"].sha2_256 is None
    assert hash_listing(spark, store, list_objects(spark, root)).count() == 0

    with open(f"{root}/empty", "wb") as f:
        f.write(b"now filled")
    again = hash_listing(spark, store, list_objects(spark, root))
    assert [r.s3key for r in again.collect()] == ["empty"]

    left = list_objects(spark, root).filter("s3key <> 'deep/x/y'")
    report = collect_garbage(spark, store, left).first()
    assert (report.n_vanished, report.n_deleted, report.n_kept) == (2, 1, 1)
    present = {r.s3key: r.present for r in store.catalog(spark).collect()}
    assert "deep/x/y" not in present and present["old/used"] is False and present["empty"] is True


def test_copy_between_stores(spark, lines, bucket, tmp_path):
    source, target = Store(f"{tmp_path}/s"), Store(f"{tmp_path}/t")
    shared = bucket(key="a", time="01/Jan/2024:05:00:00 +0000")
    ingest_files(spark, lines(shared, bucket(key="b", time="01/Jan/2024:06:00:00 +0000")), "bucket", source)
    ingest_files(spark, lines(shared), "bucket", target)
    for _ in range(2):
        copy_downloads(spark, source, target)
        assert target.facts(spark).count() == 2
        assert {r.s3key for r in target.catalog(spark).collect()} == {"a", "b"}


def test_unfinished_snapshot_is_not_current(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = spark.range(3)
    assert tables.write_snapshot(df, root) == 1
    (tmp_path / "t" / "v2").mkdir()
    assert tables.current_version(spark, root) == 1
    assert tables.write_snapshot(tables.read_snapshot(spark, root, df.schema).filter("id > 0"), root) == 3
    assert tables.read_snapshot(spark, root, df.schema).count() == 2


def test_scratch_is_in_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shuffles_grow_with_the_scan(spark, tmp_path):
    spark.range(10_000).write.parquet(f"{tmp_path}/t")
    scanned = spark.read.parquet(f"{tmp_path}/t")
    with sized_shuffles(scanned, partition_bytes=1000) as many:
        assert many > 20
        assert spark.conf.get(INITIAL_PARTITIONS_CONF) == str(many)
        assert scanned.groupBy("id").count()._jdf.queryExecution().executedPlan().toString().count(f", {many})") == 1
    assert spark.conf.get(INITIAL_PARTITIONS_CONF, None) is None
    with sized_shuffles(scanned) as few:
        assert few == 4
