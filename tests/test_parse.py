import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from accesslake import schemas
from accesslake.operators import classify as K
from accesslake.operators import parse as P

AGENT = "Surfer/3.1 (TestOS 4; x64) Engine/8 (compatible, quick)"
WEB = [
    f'198.51.100.7 - - [03/Mar/2023:14:02:41 +0100] "GET / HTTP/1.1" 403 977 "-" "{AGENT}"',
    f'203.0.113.9 - - [11/Oct/2022:22:47:30 -0700] "GET /maps/ HTTP/1.1" 200 12001 "http://h.example/maps/" "{AGENT}"',
    '203.0.113.9 - - [28/Feb/2022:00:00:09 +0000] "GET /pkg/tool-9.2.zip  HTTP/1.1" 206 73500 "-" "fetcher/2"',
    f'192.0.2.61 - - [01/Jan/2024:23:59:59 +0900] "GET /img/a.E01 HTTP/1.1" 200 8589934592 77 "http://r" "{AGENT}"',
    '192.0.2.44 - - [09/Sep/2023:07:31:00 +0530] "HEAD /db/all.csv HTTP/1.1" 304 - "-" "B"',
    '::1 - - [14/May/2021:03:03:03 +0000] "OPTIONS * HTTP/1.0" 204 - "" "self"',
    '192.0.2.4 - a[b [14/May/2021:03:03:04 +0000] "GET /q"x HTTP/1.0" 200 5',
]


def parsed(df):
    return df.withColumn("n", F.monotonically_increasing_id()).transform(P.parse_web_log).orderBy("n").collect()


def test_web_lines(lines):
    a, b, c, d, e, f, g = parsed(lines(*WEB).coalesce(1))
    assert (a.remote_ip, a.method, a.url, a.http_status, a.bytes_sent, a.referrer, a.user_agent) == (
        "198.51.100.7", "GET", "/", 403, 977, "-", AGENT,
    )
    assert a.dtime_local == datetime(2023, 3, 3, 14, 2, 41)
    assert b.referrer == "http://h.example/maps/"
    assert (c.url, c.key) == ("/pkg/tool-9.2.zip", "/pkg/tool-9.2.zip")
    assert (d.bytes_sent, d.object_size, d.referrer, d.user_agent) == (8589934592, 8589934592, None, None)
    assert (e.method, e.bytes_sent, e.operation) == ("HEAD", None, "WEBSITE.GET.OBJECT")
    assert (f.remote_ip, f.url, f.key, f.referrer) == ("::1", "*", "*", "")
    assert (g.request, g.user_agent, g.parse_error) == ('GET /q"x HTTP/1.0', None, None)
    assert all(r.source == "web" and r.parse_error is None for r in (a, b, c, d, e, f, g))


def test_web_lines_that_do_not_match(lines):
    rows = parsed(
        lines("junk", 'host.example - - [14/May/2021:03:03:05 +0000] "GET /" 200 5', '1.1.1.1 - - [x] "GET /" 200 5',
              '1.1.1.1 - - [14/May/2021:03:03:05 +0000] "GET /" 99999999999 5', "").coalesce(1)
    )
    assert [r.parse_error for r in rows] == ["fields", "fields", "time", "status", "fields"]


def test_bucket_line(lines, bucket):
    row = P.parse_bucket_log(lines(bucket(key="corpora/a%2520b%252Bc.E01"))).first()
    assert (row.bucket_owner, row.bucket, row.remote_ip, row.operation) == ("own", "bkt", "10.0.0.1", "REST.GET.OBJECT")
    assert row.key == "corpora/a b+c.E01"
    assert (row.http_status, row.bytes_sent, row.object_size, row.user_agent) == (200, 10, 100, "agent x")
    assert (row.request_uri, row.referer, row.tls_version, row.host_header) == ("GET /x HTTP/1.1", "-", "TLSv1.2", "h.example")
    assert (row.total_time, row.turn_around_time, row.error_code, row.host_id) == (160, 64, "-", "H=")
    assert row.dtime_local == datetime(2022, 8, 7, 11, 35, 52)
    assert row.parse_error is None


def test_bucket_quoting_and_short_lines(lines, bucket):
    rows = lines(
        bucket(agent="plain"), bucket(agent='""'), bucket(status="-"), bucket(key='"a key"'),
        " ".join(bucket().split(" ")[:15]), bucket(request='R" 1'),
        bucket(time="07/Xxx/2022:11:35:52 +0000"), bucket().replace(" - H= - C - h.example TLSv1.2", ""),
        bucket() + " more tokens here",
    ).withColumn("n", F.monotonically_increasing_id())
    rows = P.parse_bucket_log(rows.coalesce(1)).orderBy("n").collect()
    assert [r.user_agent for r in rows[:2]] == ["", ""]
    assert rows[2].http_status is None and rows[2].parse_error is None
    assert rows[3].key == ""
    assert rows[4].parse_error == "fields"
    assert rows[5].parse_error is not None
    assert rows[6].parse_error == "time"
    assert rows[7].parse_error is None and rows[7].host_id is None
    assert rows[8].parse_error is None and rows[8].tls_version == "TLSv1.2"


def python_tokens(line):
    """Kind and text of every token, by Python's own scanner."""
    return [
        ("q", q) if q else ("b", b) if b else ("p", p)
        for q, b, p in re.findall(r'"([^"]+)"|\[([^\]]+)\]|([^ ]+)', line)
    ]


def test_tokens_against_python(spark):
    rng = random.Random(11)
    pieces = ["a", "-", '"', '"x y"', "[", "]", "[t 1]", " ", " ", "  ", '""', "[]", 'b"c', "é", "%20"]
    rows = [" ".join(rng.choices(pieces, k=rng.randint(15, 26))) if i % 2 else "".join(rng.choices(pieces, k=60)) for i in range(400)]
    df = spark.createDataFrame([(r,) for r in rows], "line string")
    kinds = {"bucket_owner": "p", "operation": "p", "request_uri": "q", "user_agent": "q", "referer": "q", "tls_version": "p", "host_id": "p"}
    for got in P.parse_bucket_log(df).collect():
        tokens = python_tokens(got.line)
        assert (got.parse_error == "fields") == (len(tokens) < 17)
        if len(tokens) >= 17:
            for name, kind in kinds.items():
                i = P.BUCKET_POSITIONS[name]
                want = None if i >= len(tokens) else tokens[i][1] if tokens[i][0] == kind else ""
                assert got[name] == want, (got.line, name)


def test_modes(lines, bucket):
    parsed_rows = P.parse_bucket_log(lines(bucket(), "junk"))
    assert P.good_records(parsed_rows).count() == 1
    assert [tuple(r) for r in P.malformed_lines(parsed_rows).collect()] == [("junk", "fields")]
    with pytest.raises(Exception, match="malformed log line"):
        P.good_records(parsed_rows, "failfast").select("key").collect()
    strict = P.good_records(parsed_rows, "failfast")
    for later in (K.downloads_only(K.classify(strict)), K.filter_year(strict, 2022), strict.filter("key = 'zz'")):
        with pytest.raises(Exception, match="malformed log line"):
            later.collect()
    assert K.filter_year(P.good_records(P.parse_bucket_log(lines(bucket())), "failfast"), 2022).count() == 1
    with pytest.raises(ValueError):
        P.good_records(parsed_rows, "skip")


def test_unify_and_register(lines, bucket):
    web = P.good_records(P.parse_logs(lines(WEB[2]), "web"))
    own = P.good_records(P.parse_logs(lines(bucket(key="pkg/tool-9.2.zip")), "bucket"))
    both = P.unify_logs(web, own)
    assert set(schemas.ACCESS_LOG.fieldNames()) == set(both.columns)
    types = {f.name: f.dataType for f in both.schema}
    assert all(types[f.name] == f.dataType for f in schemas.ACCESS_LOG)
    assert both.select("key").distinct().count() == 2
    assert P.normalize_keys(both).select("key").distinct().count() == 1
    P.register_log_format("upper", lambda df: df.withColumn("line", F.upper("line")))
    assert P.parse_logs(lines("a"), "upper").first().line == "A"
    with pytest.raises(KeyError):
        P.parse_logs(lines("a"), "none")


def classes(lines, bucket, cases):
    df = lines(*[bucket(op=o, status=s, request=f"R{i}") for i, (o, s) in enumerate(cases)])
    got = {r.request_id: r["class"] for r in K.classify(P.parse_bucket_log(df)).collect()}
    return [got[f"R{i}"] for i in range(len(cases))]


def test_every_operation_has_its_class(lines, bucket):
    families = [
        (schemas.GET_OPERATIONS, "DOWNLOAD", 3), (schemas.WRITE_OPERATIONS, "UPLOAD", 6),
        (schemas.DELETE_OPERATIONS, "DELETED", 7), (schemas.MISC_OPERATIONS, "MISC", 51),
    ]
    for names, want, size in families:
        assert len(set(names)) == size
        assert set(classes(lines, bucket, [(n, "200") for n in names])) == {want}
    assert classes(lines, bucket, [("REST.NEW.THING", "200")]) == ["UNKNOWN"]


def test_status_rules(lines, bucket):
    get = [("REST.GET.OBJECT", s) for s in ("200", "206", "-", "204", "304", "404", "500", "503", "100")]
    assert classes(lines, bucket, get) == ["DOWNLOAD"] * 3 + ["BAD"] * 6
    put = [("REST.PUT.OBJECT", s) for s in ("200", "399", "400", "403", "499", "500", "-")]
    assert classes(lines, bucket, put) == ["UPLOAD"] * 2 + ["BLOCKED"] * 3 + ["UPLOAD"] * 2


def test_ignored_keys(spark, lines, bucket):
    records = P.good_records(P.parse_bucket_log(lines(bucket(key="a%20b"), bucket(key="c"), bucket(key="d"))))
    ignored = spark.createDataFrame([("a b",), ("d",), ("d",), ("zz",)], "key string")
    assert [r.key for r in K.drop_ignored_keys(records, ignored).collect()] == ["c"]


def test_year_is_that_of_the_wall_clock(lines):
    df = lines('1.1.1.1 - - [31/Dec/2019:23:00:00 -0700] "GET / HTTP/1.1" 200 5')
    records = P.good_records(P.parse_web_log(df))
    assert K.filter_year(records, 2019).count() == 1
    assert K.filter_year(records, 2020).count() == 0
    assert K.filter_year(records, None).count() == 1


def test_parse_stays_in_the_jvm_and_matches_each_line_once(lines, bucket, plan):
    df = K.downloads_only(K.classify(P.good_records(P.parse_bucket_log(lines(bucket())))))
    text = plan(df.select("key", "dtime", "http_status"))
    assert "Python" not in text
    assert text.count('regexp_replace(line') == 1
    assert text.count("gettimestamp") == 1
