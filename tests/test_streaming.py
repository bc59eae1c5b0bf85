from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from accesslake.operators import classify as K
from accesslake.operators import parse as P
from accesslake.plans.summarize import reroll_days
from accesslake.sources.logs import stream_logs
from accesslake.streaming import ingest as SI
from accesslake.streaming import live as SL


@pytest.fixture
def arrive(tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, *rows):
        (tmp_path / "in" / name).write_text("\n".join(rows) + "\n")

    write.path = f"{tmp_path}/in"
    return write


def when(day, hour=5):
    return f"{day:02d}/Jan/2024:{hour:02d}:00:00 +0000"


def facts(spark, landing):
    files = landing.catalog(spark).select(F.col("id").alias("did"), "s3key")
    rows = landing.facts(spark).join(files, "did").select("s3key", "dtime", "bytes_sent").collect()
    return sorted(tuple(r) for r in rows)


def test_ingest_resumes_and_counts_each_line_once(spark, arrive, bucket, tmp_path):
    landing, checkpoint = SI.Landing(f"{tmp_path}/landing"), f"{tmp_path}/cp"
    ignored = spark.createDataFrame([("no",)], "key string")

    def run():
        SI.ingest_stream(stream_logs(spark, arrive.path, 1), landing, checkpoint, "bucket", ignored).awaitTermination()

    arrive("a.log", bucket(key="a", size="1", time=when(1)), bucket(key="no"), bucket(op="REST.PUT.OBJECT"), "", "junk")
    arrive("b.log", bucket(key="b", size="2", time=when(2), agent='"other"'))
    run()
    run()
    assert len(facts(spark, landing)) == 2
    arrive("c.log", bucket(key="a", size="9", time=when(3)), bucket(key="a", size="9", time=when(3)))
    run()
    assert facts(spark, landing) == [
        ("a", datetime(2024, 1, 1, 5), 10), ("a", datetime(2024, 1, 3, 5), 10), ("a", datetime(2024, 1, 3, 5), 10),
        ("b", datetime(2024, 1, 2, 5), 10),
    ]
    assert {(r.s3key, r.bytes) for r in landing.catalog(spark).collect()} == {("a", 1), ("b", 2)}
    assert {r.user_agent for r in landing.agents(spark).collect()} == {"agent x", "other"}
    assert landing.agents(spark).count() == 2
    assert {(r["class"], r.n) for r in landing.class_counts(spark).collect()} == {("DOWNLOAD", 4), ("UPLOAD", 1), ("MALFORMED", 1)}
    assert [tuple(r) for r in landing.malformed(spark).collect()] == [("junk", "fields")]
    assert spark.read.text(f"{landing.root}/archive").count() == 4


def test_a_repeated_batch_changes_nothing(spark, lines, bucket, tmp_path):
    landing = SI.Landing(f"{tmp_path}/landing")
    batches = [lines(bucket(key="a", size="1"), bucket(key="b")), lines(bucket(key="a", size="5"), bucket(key="c"))]
    for number in (0, 1, 1, 0, 1):
        SI.land_batch(batches[number], number, landing, "bucket")
    assert landing.facts(spark).count() == 4
    assert sorted(r.s3key for r in landing.catalog(spark).collect()) == ["a", "b", "c"]
    assert landing.class_counts(spark).first().n == 4


def test_batches_without_downloads(spark, lines, bucket, tmp_path):
    landing = SI.Landing(f"{tmp_path}/landing")
    SI.land_batch(lines(""), 0, landing, "bucket")
    SI.land_batch(lines(bucket(op="REST.PUT.OBJECT")), 1, landing, "bucket")
    assert landing.facts(spark).count() == 0 and landing.catalog(spark).count() == 0
    SI.land_batch(lines(bucket(key="a")), 2, landing, "bucket")
    assert landing.facts(spark).count() == 1 and landing.catalog(spark).count() == 1
    assert {(r["class"], r.n) for r in landing.class_counts(spark).collect()} == {("UPLOAD", 1), ("DOWNLOAD", 1)}


def test_compacted_dimensions(spark, lines, bucket, tmp_path):
    landing = SI.Landing(f"{tmp_path}/landing")
    landing.compact(spark)
    SI.land_batch(lines(bucket(key="a", size="1"), bucket(key="b")), 0, landing, "bucket")
    SI.land_batch(lines(bucket(key="a", size="5"), bucket(key="c", agent='"z"')), 1, landing, "bucket")
    for _ in range(2):
        landing.compact(spark)
        assert sorted((r.s3key, r.bytes) for r in landing.catalog(spark).collect()) == [("a", 1), ("b", 100), ("c", 100)]
    SI.land_batch(lines(bucket(key="c", size="7"), bucket(key="d")), 2, landing, "bucket")
    SI.land_batch(lines(bucket(key="a", size="5"), bucket(key="c", agent='"z"')), 1, landing, "bucket")
    assert sorted(r.s3key for r in landing.catalog(spark).collect()) == ["a", "b", "c", "d"]
    assert landing.agents(spark).count() == 2
    read = landing.catalog(spark).inputFiles()
    assert not [f for f in read if "batch_id=0" in f or "batch_id=1" in f]


def test_late_rows_reach_the_daily_table_by_rerolling(spark, lines, bucket, tmp_path):
    landing, daily = SI.Landing(f"{tmp_path}/landing"), f"{tmp_path}/daily"
    SI.land_batch(lines(bucket(time=when(1)), bucket(time=when(1, 6)), bucket(time=when(2))), 0, landing, "bucket")
    reroll_days(landing.downloads(spark), daily)
    SI.land_batch(lines(bucket(time=when(1, 7), sent="5")), 1, landing, "bucket")
    touched = landing.downloads(spark).filter("batch_id = 1").select("dt")
    for _ in range(2):
        reroll_days(landing.downloads(spark), daily, touched)
    got = {r.dt: (r.bytes_sent, r.summary) for r in spark.read.parquet(daily).collect()}
    assert got == {date(2024, 1, 1): (25, True), date(2024, 1, 2): (10, True)}


def records(spark, path):
    return P.good_records(P.parse_bucket_log(K.nonblank_lines(stream_logs(spark, path, 1))))


def test_dedup_over_files_and_batches(spark, arrive, bucket, tmp_path):
    hot = bucket(key="hot")
    arrive("a.log", *[hot] * 50, bucket(key="a"))
    arrive("b.log", *[hot] * 50, bucket(key="b"))
    out = f"{tmp_path}/out"
    for _ in range(2):
        view = SL.dedup_stream(records(spark, arrive.path)).select("line", "key")
        SL.write_changes(view, out, f"{tmp_path}/cp", mode="append").awaitTermination()
        arrive("c.log", hot, bucket(key="c"))
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "hot"]


def test_daily_sums_and_class_counts(spark, arrive, bucket, tmp_path):
    arrive("a.log", bucket(key="a", time=when(1)), bucket(key="a", time=when(1, 7), sent="5"), bucket(key="b", time=when(2), status="404"))
    arrive("b.log", bucket(key="a", time=when(1, 8), sent="1"), bucket(key="a", time=when(2)))
    classified = K.classify(records(spark, arrive.path))
    sums, counts = f"{tmp_path}/sums", f"{tmp_path}/counts"
    SL.write_changes(SL.daily_sums(K.downloads_only(classified)), sums, f"{tmp_path}/cp1").awaitTermination()
    SL.write_changes(SL.class_counts_stream(classified), counts, f"{tmp_path}/cp2").awaitTermination()
    got = SL.latest_values(spark, sums, ["dt", "key", "remote_ipaddr", "user_agent"], "bytes_sent").collect()
    assert {(r.dt, r.key): r.bytes_sent for r in got} == {(date(2024, 1, 1), "a"): 16, (date(2024, 1, 2), "a"): 10}
    tally = SL.latest_values(spark, counts, ["class"], "n").collect()
    assert {r["class"]: r.n for r in tally} == {"DOWNLOAD": 4, "BAD": 1}


def test_read_files_can_be_archived(spark, arrive, bucket, tmp_path):
    arrive("a.log", bucket())
    source = stream_logs(spark, arrive.path, 1, clean_source="archive", archive_dir=f"{tmp_path}/done")
    landing = SI.Landing(f"{tmp_path}/landing")
    SI.ingest_stream(source, landing, f"{tmp_path}/cp", "bucket").awaitTermination()
    assert landing.facts(spark).count() == 1
