import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from accesslake.operators import merge as M
from accesslake.operators import parse as P
from accesslake.operators import rollup as A
from accesslake.operators.classify import nonblank_lines
from accesslake.plans.merge import merge_logs
from accesslake.sources.logs import archive_lines, read_ignored_keys, scan_logs


def web(second, path="/a", day="05/Jul/2020", zone="+0000"):
    return f'1.1.1.1 - - [{day}:00:00:{second:02d} {zone}] "GET {path} HTTP/1.1" 200 5 "-" "x"'


def write(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "\n".join(rows) + "\n"
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(data)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(data)


def test_scan_takes_trees_and_compressed_files(spark, tmp_path):
    write(f"{tmp_path}/in/a.log", "one", "", "  two ")
    write(f"{tmp_path}/in/deep/er/b.gz", "thrée")
    write(f"{tmp_path}/in/deep/no_suffix", "four")
    got = {r.line for r in nonblank_lines(scan_logs(spark, f"{tmp_path}/in")).collect()}
    assert got == {"one", "two", "thrée", "four"}
    both = scan_logs(spark, [f"{tmp_path}/in/a.log", f"{tmp_path}/in/deep"])
    assert nonblank_lines(both).count() == 4
    assert scan_logs(spark, [f"{tmp_path}/none", f"{tmp_path}/in/*.log"]).count() == 3
    assert scan_logs(spark, f"{tmp_path}/none").count() == 0


def test_ignore_list(spark, tmp_path):
    write(f"{tmp_path}/ignore.txt", "a/b.csv ", "c")
    assert {r.key for r in read_ignored_keys(spark, f"{tmp_path}/ignore.txt").collect()} == {"a/b.csv", "c"}


def test_merge_job(spark, tmp_path):
    a = [web(30), web(10, "/tie2"), web(10, "/tie1"), "", web(5, day="05/Jul/2019")]
    b = [web(20), web(30), "  " + web(10, "/tie1") + " ", web(1, zone="-0100"), web(7, day="05/Jul/2019"), web(5, day="05/Jul/2019")]
    write(f"{tmp_path}/in/a.log", *a)
    write(f"{tmp_path}/in/b.log.gz", *b)
    report = merge_logs(spark, f"{tmp_path}/in", f"{tmp_path}/out", "web", year=2020)
    parts = sorted(p for p in os.listdir(f"{tmp_path}/out") if p.startswith("part-"))
    merged = [line for p in parts for line in open(f"{tmp_path}/out/{p}").read().splitlines()]
    assert merged == [web(10, "/tie2"), web(10, "/tie1"), web(20), web(30), web(1, zone="-0100")]
    assert (report.total_read, report.dups, report.filtered, report.written) == (8, 3, 2, 5)
    assert (report.earliest, report.latest) == (datetime(2020, 7, 5, 0, 0, 10), datetime(2020, 7, 5, 1, 0, 1))


def test_malformed_line_ends_a_merge(lines):
    with pytest.raises(Exception, match="malformed log line"):
        M.merge_records(lines(web(1), "junk"), "web", year=2020).collect()
    assert M.merge_records(lines(web(1), "junk"), "web", year=2020, mode="quarantine").count() == 1


def test_report_of_nothing(lines):
    row = M.merge_report(lines(""), "web").first()
    assert (row.total_read, row.dups, row.written, row.earliest) == (0, 0, 0, None)


def test_merge_of_lines_without_position_has_one_order(lines):
    df = lines(web(3), web(1, "/b"), web(1, "/a"))
    for parts in (1, 3):
        got = [r.line for r in M.merge_records(df.repartition(parts), "web").collect()]
        assert got == [web(1, "/a"), web(1, "/b"), web(3)]


def test_copies_fold_before_the_shuffle(lines, plan):
    text = plan(M.dedup_lines(lines("a", "a")))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_archive_by_record_year(spark, tmp_path, lines):
    rows = P.good_records(P.parse_web_log(lines(web(1), web(2, day="31/Dec/2019", zone="-0700"))))
    for _ in range(2):
        archive_lines(rows, f"{tmp_path}/arch")
    got = spark.read.text(f"{tmp_path}/arch").groupBy("year").count().collect()
    assert {(r.year, r["count"]) for r in got} == {(2020, 2), (2019, 2)}


def brute_batches(rows, size):
    """(processed, first, last) per closed batch of one file."""
    out, seen = [], []
    for i, (line, t) in enumerate(rows):
        if not line.strip():
            continue
        seen.append(t)
        if i > 0 and i % size == 0:
            out.append((i, min(seen), max(seen)))
            seen = []
    return out


def test_batch_bounds_over_files_cut_into_splits(spark, tmp_path, plan):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        want = {}
        for f in range(3):
            rows = []
            for i in range(150 + 61 * f):
                s = (i * 37 + f) % 60
                blank = (i * (f + 3)) % 10 == 0
                rows.append(("" if blank else web(s, f"/f{f}/{i}"), datetime(2020, 7, 5, 0, 0, s)))
            write(f"{tmp_path}/in/f{f}.log", *[r[0] for r in rows])
            want[f"f{f}.log"] = brute_batches(rows, 20)
        scanned = scan_logs(spark, f"{tmp_path}/in")
        assert scanned.select("file_path", "file_block_start").distinct().count() > 6
        numbered = A.number_lines(scanned)
        assert "BroadcastHashJoin" in plan(numbered) and "SortMergeJoin" not in plan(numbered)
        index = numbered.groupBy("file_path").agg(
            F.count("*").alias("n"), F.count_distinct("line_index").alias("d"), F.max("line_index").alias("m"))
        assert all(r.n == r.d == r.m + 1 for r in index.collect())
        records = P.good_records(P.parse_web_log(nonblank_lines(numbered)))
        got = {}
        for r in A.batch_bounds(records, 20).orderBy("processed").collect():
            got.setdefault(os.path.basename(r.file_path), []).append((r.processed, r.earliest, r.latest))
        assert got == {k: v for k, v in want.items() if v}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changed_splits_are_noticed(spark, tmp_path):
    write(f"{tmp_path}/in/a.log", *[web(i % 60, f"/{i}") for i in range(300)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    numbered = A.number_lines(scan_logs(spark, f"{tmp_path}/in"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Exception, match="input splits changed"):
            numbered.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert numbered.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == before
