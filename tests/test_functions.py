import hashlib
import random
import re
from datetime import datetime
from urllib.parse import quote, unquote, urlsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accesslake.functions import digests, ids, text, times


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_matches_python(spark):
    values = [chr(c) + " a b " + chr(c) for c in range(1, 0x3100) if chr(c).isspace()] + ["", " ", "x"]
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert len(text.WHITESPACE) == 29


def test_safe_int(spark):
    assert column(spark, ["12", "-", "", "x1", "4294967296", "99999999999999999999", None], text.safe_int) == [
        12, None, None, None, 4294967296, None, None,
    ]


def test_percent_decode_matches_python(spark):
    rng = random.Random(3)
    pieces = ["%25", "%2520", "+", "%", "%zz", "a", "/", "%C3%A9", "%252B", "é", "%41", "%2", " "]
    values = ["".join(rng.choices(pieces, k=rng.randint(0, 8))) for _ in range(500)]
    assert column(spark, values, text.percent_decode) == [unquote(unquote(v)) for v in values]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=30))
def test_percent_decode_undoes_encoding(spark, values):
    assert column(spark, [quote(quote(v)) for v in values], text.percent_decode) == values


def test_url_path(spark):
    expected = {
        "/a/b?q#f": "/a/b", "http://h/a;b/c;d": "/a;b/c", "http://h": "", "//h/x": "/x", "*": "*", "/a|b[c": "/a|b[c",
        "mailto:x;y": "x;y", "a:b/c?d": "b/c", "/x#y?z": "/x", "": "", "https://h:80/p;x?y": "/p", "9a:b/c": "9a:b/c",
        "/p/;a;b": "/p/",
    }
    assert column(spark, list(expected), text.url_path) == list(expected.values())
    assert column(spark, [None], text.url_path) == [""]
    plain = [u for u in expected if ";" not in u]
    assert column(spark, plain, text.url_path) == [urlsplit(u).path for u in plain]


def test_wikipage(spark):
    urls = ["/index.php?title=A&b", "/wiki/B c", "/index.php?title=", "/wiki/X&index.php?title=Y", "/z", None]
    assert column(spark, urls, text.wikipage) == ["A", "B", "", "Y", None, None]


def test_is_download(spark):
    urls = ["/a.gz", "/a.E01", "/a.e99", "/a.CSV", "/a.gz?x", "/agz", "/a.sql", "/a.iso ", None, "/a.E1"]
    assert column(spark, urls, text.is_download) == [True, True, True, True, False, False, False, False, False, False]


def test_request_parts(spark):
    requests = ["GET /a  HTTP/1.1", "OPTIONS * HTTP/1.0", "-", ""]
    assert column(spark, requests, text.request_method) == ["GET", "OPTIONS", "-", ""]
    assert column(spark, requests, text.request_url) == ["/a", "*", None, None]


def test_clean_log_date(spark):
    dirty = '08/Apr/2018:01:02:03 +0200] "GET /x y z 203.0.113.5'
    values = [dirty, "08/Apr/2018:01:02:03 +0200", "]x", "none"]
    assert column(spark, values, times.clean_log_date) == [
        "08/Apr/2018 01:02:03 +0200", "08/Apr/2018 01:02:03 +0200", "]x", "none",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clocks_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = ["31/Dec/2019 23:30:00 -0700", "10/Mar/2024 02:30:00 +0000", "3/Nov/2024 01:30:00 -0430", "1/Foo/2020 00:00:00 +0000", "1/Jan/2020 10:00:00"]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        df = df.withColumn("z", times.with_offset(F.col("v"))).withColumn("t", times.log_instant(F.col("z")))
        rows = df.select("i", F.unix_seconds("t").alias("t"), times.log_wall_clock(F.col("z"), F.col("t")).alias("w")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for value, row in zip(values, rows):
        if "Foo" in value:
            assert (row.t, row.w) == (None, None)
            continue
        zoned = value if re.search(r"[+-]\d{4}$", value) else value + " +0000"
        want = datetime.strptime(zoned, "%d/%b/%Y %H:%M:%S %z")
        assert row.t == want.timestamp()
        assert row.w == want.replace(tzinfo=None)


def test_digests_and_ids(spark):
    values = ["", "abc", "é" * 5000, None]
    sha2 = column(spark, values, digests.sha2_256)
    sha3 = column(spark, values, digests.sha3_256)
    assert sha2 == [None if v is None else hashlib.sha256(v.encode()).hexdigest() for v in values]
    assert sha3 == [None if v is None else hashlib.sha3_256(v.encode()).hexdigest() for v in values]
    assert column(spark, values, ids.surrogate_id) == [v and v[:32] for v in sha2]
