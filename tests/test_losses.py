"""Input that must not be lost without a word."""

import pytest

from accesslake.operators import classify as K
from accesslake.operators import parse as P
from accesslake.plans.corpus import collect_garbage
from accesslake.plans.store import Store
from accesslake.sources import tables
from accesslake.sources.listing import list_objects
from accesslake.sources.logs import scan_logs, stream_logs
from accesslake.streaming import live


@pytest.fixture
def days(tmp_path, bucket):
    """Thirty files of a line each, newest first, and a copy of every line in a file of its own."""
    import os

    root = tmp_path / "days"
    root.mkdir()
    for n in range(60):
        day = 30 - n // 2
        path = root / f"f{n:02}.log"
        path.write_text(bucket(time=f"{day:02}/Jun/2022:10:00:00 +0000", request=f"R{day}", key=f"corpora/{day}.E01") + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(root)


def run(spark, view, tmp_path, name, mode):
    out = f"{tmp_path}/{name}"
    live.write_changes(view, out, f"{tmp_path}/{name}-state", mode=mode).awaitTermination()
    return out


def test_streams_are_exact_over_many_batches(spark, days, tmp_path):
    records = lambda: P.good_records(P.parse_bucket_log(stream_logs(spark, days, 7)))
    lines = run(spark, live.dedup_stream(records()).select("line"), tmp_path, "lines", "append")
    assert spark.read.parquet(lines).count() == 30
    sums = run(spark, live.daily_sums(K.downloads_only(K.classify(records()))), tmp_path, "sums", "update")
    latest = live.latest_values(spark, sums, ["dt", "key", "remote_ipaddr", "user_agent"], "bytes_sent").collect()
    assert len(latest) == 30 and all(r.bytes_sent == 20 for r in latest)


def test_hidden_files_are_named(spark, tmp_path):
    (tmp_path / "_x").write_text("a\n"), (tmp_path / "y").write_text("b\n"), (tmp_path / "_SUCCESS").write_text("")
    with pytest.raises(ValueError, match="_x"):
        scan_logs(spark, str(tmp_path))
    assert scan_logs(spark, str(tmp_path), skip_hidden=True).count() == 1


def test_names_that_look_like_patterns(spark, tmp_path):
    (tmp_path / "a[1].log").write_text("b\n")
    assert scan_logs(spark, f"{tmp_path}/a[1].log").count() == 1


def test_snapshot_without_spark_marker(spark, tmp_path):
    root, df = f"{tmp_path}/t", spark.createDataFrame([(1,)], "a int")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        tables.write_snapshot(df, root)
        assert tables.read_snapshot(spark, root, df.schema).count() == 1
        df.write.parquet(f"{root}/v2")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    tables.drop_path(spark, f"{root}/v2/_SUCCESS")
    with pytest.raises(ValueError, match="marker"):
        tables.read_snapshot(spark, root, df.schema)


def test_old_snapshots_expire(spark, tmp_path):
    root, df = f"{tmp_path}/t", spark.createDataFrame([(1,)], "a int")
    for _ in range(tables.OLD_VERSIONS + 3):
        tables.write_snapshot(df, root)
    assert len([n for n in tables.child_names(spark, root) if n.startswith("v")]) == tables.OLD_VERSIONS + 1


def test_missing_root_and_empty_listing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_objects(spark, f"{tmp_path}/mistyped")
    empty = spark.createDataFrame([], "s3key string, etag string, mtime timestamp, bytes bigint")
    with pytest.raises(ValueError, match="empty"):
        collect_garbage(spark, Store(f"{tmp_path}/store"), empty)
