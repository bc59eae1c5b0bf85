"""Lenient dates and the options of an ingest."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from accesslake.functions import times as T
from accesslake.operators.parse import parse_logs
from accesslake.plans.ingest import ingest_files
from accesslake.plans.store import Store
from accesslake.sources.logs import scan_logs

#: Date as written, wall clock, minutes east of UTC.
DATES = [
    ("08/Apr/2018 01:02:03 +0200", "2018-04-08 01:02:03", 120), ("08/Apr/2018:01:02:03 -0730", "2018-04-08 01:02:03", -450),
    ("8 April 2018", "2018-04-08 00:00:00", 0), ("8-apr-18 13:02", "2018-04-08 13:02:00", 0), ("1st March 1999 at 7:05 pm", "1999-03-01 19:05:00", 0),
    ("Sun Apr  8 01:02:03 2018", "2018-04-08 01:02:03", 0), ("Sep 9 23:59:59 2001 -0100", "2001-09-09 23:59:59", -60),
    ("April 8, 2018 1:02:03 PM", "2018-04-08 13:02:03", 0), ("Dec 31, 1969 12:00 am", "1969-12-31 00:00:00", 0),
    ("2018-04-08T01:02:03.5Z", "2018-04-08 01:02:03.500000", 0), ("2018-04-08 01:02:03,123456789+02:00", "2018-04-08 01:02:03.123456", 120),
    ("2018/4/8", "2018-04-08 00:00:00", 0), ("2018-Apr-08 06:07:08", "2018-04-08 06:07:08", 0), ("20180408T010203", "2018-04-08 01:02:03", 0),
    ("20180408", "2018-04-08 00:00:00", 0), ("04/08/2018 01:02 +05", "2018-04-08 01:02:00", 300), ("25/12/2018", "2018-12-25 00:00:00", 0),
    ("12/25/68", "2068-12-25 00:00:00", 0), ("12/25/69", "1969-12-25 00:00:00", 0), ("Sunday, 08-Apr-18 01:02:03 GMT", "2018-04-08 01:02:03", 0),
]
NONE = ["", " ", "no date", "12:30", "02/Jan/20x4 01:02:03", "31/Feb/2018", "13/13/2018", "08/Apr/2018 25:02:03", "8 Foo 2018", "2018-04-08T01:02:03 junk", "April 8, 2018 13:00 PM", None]


def test_lenient_dates(spark):
    rows = spark.createDataFrame([(d,) for d in [d for d, _, _ in DATES] + NONE], "d string")
    parts = rows.withColumn("p", T.lenient_parts(F.col("d"))).withColumn("w", T.lenient_wall_clock(F.col("p")))
    found = {r.d: (r.w, r.i) for r in parts.select("d", "w", F.unix_micros(T.lenient_instant(F.col("p"), F.col("w"))).alias("i")).collect()}
    for date, wall, minutes in DATES:
        want = datetime.fromisoformat(wall)
        assert found[date][0] == want, date
        assert found[date][1] == round(want.replace(tzinfo=UTC).timestamp() * 1e6) - minutes * 60_000_000, date
    assert [found[d] for d in NONE] == [(None, None)] * len(NONE)


def test_lenient_formats_read_what_the_strict_ones_refuse(spark, lines, bucket):
    rows = lines(bucket(time="2022-08-07T11:35:52Z"), bucket(), bucket(time="yesterday"))
    strict, lenient = [[(r.dtime_local, r.parse_error) for r in parse_logs(rows, f).collect()] for f in ("bucket", "bucket_lenient")]
    instant = datetime(2022, 8, 7, 11, 35, 52)
    assert strict == [(None, "time"), (instant, None), (None, "time")]
    assert lenient == [(instant, None), (instant, None), (None, "time")]


def test_counters_of_an_ingest(spark, bucket, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.log").write_text(bucket(time="01/Jan/2024:05:00:00 +0100") + "\n" + bucket(op="REST.PUT.OBJECT", time="09/Jan/2024:05:00:00 +0000") + "\n\njunk\n")
    (tmp_path / "in/b.log").write_text(bucket(time="02/Jan/2024:05:00:00 +0000") + "\n")
    found = ingest_files(spark, scan_logs(spark, f"{tmp_path}/in"), "bucket", Store(f"{tmp_path}/s"))
    assert (found.n_objects, found.n_records, found.n_downloads, found["MALFORMED"]) == (2, 3, 2, 1)
    assert (found.earliest, found.latest) == (datetime(2024, 1, 1, 4, tzinfo=UTC), datetime(2024, 1, 2, 5, tzinfo=UTC))


def test_counters_of_nothing(spark, lines, tmp_path):
    found = ingest_files(spark, lines(""), "bucket", Store(f"{tmp_path}/s"))
    assert (found.n_objects, found.n_records, found.n_downloads, found.earliest, found.latest) == (None, 0, 0, None, None)


def test_normalized_keys_meet(spark, lines, bucket, tmp_path):
    store = Store(f"{tmp_path}/s")
    web = '1.2.3.4 - - [08/Apr/2018:01:02:03 +0200] "GET /corpora/a.E01 HTTP/1.1" 200 5 "-" "x"'
    ingest_files(spark, lines(bucket()), "bucket", store, normalize=True)
    ingest_files(spark, lines(web), "web", store, normalize=True)
    assert [r.s3key for r in store.catalog(spark).collect()] == ["corpora/a.E01"] and store.facts(spark).select("did").distinct().count() == 1


def test_collated_keys_and_lookup(spark, lines, bucket, tmp_path):
    store = Store(f"{tmp_path}/s")
    for key in ("Corpora/É.E01", "corpora/e.e01"):
        ingest_files(spark, lines(bucket(key=key)), "bucket", store, collation="UNICODE_CI_AI")
    assert [r.s3key for r in store.catalog(spark).collect()] == ["Corpora/É.E01"]
    assert store.facts(spark).select("did").distinct().count() == 1 and store.facts(spark).count() == 2
    other = Store(f"{tmp_path}/o")
    ingest_files(spark, lines(bucket(key="a")), "bucket", other, lookup=True)
    assert other.facts(spark).first().did == other.catalog(spark).first().id
    with pytest.raises(ValueError, match="collation"):
        ingest_files(spark, lines(bucket()), "bucket", Store(f"{tmp_path}/b", 4), collation="UNICODE_CI_AI")
