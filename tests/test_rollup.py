from collections import defaultdict
from datetime import date, datetime

from pyspark.sql import functions as F

from accesslake.operators import reports as R
from accesslake.operators import rollup as A

SCHEMA = "did string, user_agent_id string, remote_ipaddr string, dtime timestamp_ntz, bytes_sent bigint, summary boolean, dt date"


def facts(spark, rows):
    full = [(d, a, ip, t, b, s, t.date()) for d, a, ip, t, b, s in rows]
    return spark.createDataFrame(full, SCHEMA)


D1, D2, D3 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 23, 59, 59), datetime(2024, 1, 3)
ROWS = [
    ("f", "a", "i", D1, 5, False), ("f", "a", "i", D1.replace(hour=7), None, False), ("f", None, "i", D1, 1, False),
    ("f", None, "i", D1, 2, False), ("f", "a", None, D1, None, False), ("f", "a", "i", datetime(2024, 1, 1), 100, True),
    ("g", "a", "i", D2, 7, False), ("g", "a", "i", D3, 9, False), ("g", "a", "i", D3, 1, True),
]


def brute(rows, first, last):
    kept, sums = [], defaultdict(list)
    for d, a, ip, t, b, s in rows:
        if not s and first <= t.date() <= last:
            sums[(d, a, ip, t.date())].append(b)
        else:
            kept.append((d, a, ip, t, b, s))
    for (d, a, ip, day), values in sums.items():
        known = [v for v in values if v is not None]
        kept.append((d, a, ip, datetime.combine(day, datetime.min.time()), sum(known) if known else None, True))
    return sorted(kept, key=str)


def test_summarize_against_brute_force(spark):
    df = facts(spark, ROWS)
    for first, last in [(date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 3), date(2024, 1, 3)), (date(2025, 1, 1), date(2025, 1, 2))]:
        out = A.summarize(df, first, last)
        got = sorted([(r.did, r.user_agent_id, r.remote_ipaddr, r.dtime, r.bytes_sent, r.summary) for r in out.collect()], key=str)
        assert got == brute(ROWS, first, last)
        assert out.filter("dt <> to_date(dtime)").count() == 0


def test_savings_equal_the_row_counts(spark):
    df = facts(spark, ROWS)
    after = {r.dt: r["count"] for r in A.summarize(df).groupBy("dt").count().collect()}
    before = {r.dt: r["count"] for r in df.groupBy("dt").count().collect()}
    for r in A.rollup_savings(df).collect():
        assert (r.rows_before, r.rows_after, r.saved) == (before[r.dt], after[r.dt], before[r.dt] - after[r.dt])
    one = A.rollup_savings(df, "2024-01-02", "2024-01-02").collect()
    assert [(r.dt, r.saved) for r in one] == [(date(2024, 1, 2), 0)]


def test_second_run_adds_rows_and_compact_folds_them(spark):
    once = A.summarize(facts(spark, ROWS))
    late = once.unionByName(facts(spark, [("f", "a", "i", D1, 3, False)]))
    again = A.summarize(late)
    same = again.filter("did = 'f' and user_agent_id = 'a' and remote_ipaddr = 'i'")
    assert sorted(r.bytes_sent for r in same.collect()) == [3, 5, 100]
    folded = A.summarize(late, compact=True).filter("did = 'f' and user_agent_id = 'a' and remote_ipaddr = 'i'")
    assert [r.bytes_sent for r in folded.collect()] == [108]
    assert A.summarize(once).count() == once.count()


def test_bounds(spark):
    df = facts(spark, ROWS)
    assert tuple(A.rollup_bounds(df).first()) == (date(2024, 1, 1), date(2024, 1, 3))
    assert tuple(A.rollup_bounds(A.summarize(df)).first()) == (None, None)
    assert A.year_range(2023) == ("2023-01-01", "2023-12-31")


def test_year_rollover_sums_both_kinds(spark):
    got = {(r.did, r.user_agent_id, r.remote_ipaddr, r.dt): r.bytes_sent for r in A.year_rollover(facts(spark, ROWS)).collect()}
    assert got[("f", "a", "i", date(2024, 1, 1))] == 105
    assert got[("g", "a", "i", date(2024, 1, 3))] == 10
    assert len(got) == 5


def test_store_stats(spark):
    files = spark.createDataFrame([("a",), ("b",)], "s3key string")
    assert tuple(A.store_stats(files, facts(spark, ROWS)).first()) == (2, 9, datetime(2024, 1, 1), D3)
    assert tuple(A.store_stats(files.limit(0), facts(spark, [])).first()) == (0, 0, None, None)


def test_day_range_prunes_partitions(spark, tmp_path, plan):
    path = f"{tmp_path}/facts"
    facts(spark, ROWS).write.partitionBy("dt").parquet(path)
    df = spark.read.schema(SCHEMA).parquet(path)
    rolled = A.daily_rollup(df, "2024-01-01", "2024-01-01")
    text = rolled._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert {r.bytes_sent for r in rolled.collect()} == {5, 3, None}
    assert len([f for f in rolled.inputFiles()]) > 0


def test_popular_downloads(spark, plan):
    rows = [("a", date(2024, 1, 30), 5)] * 2 + [("b", date(2024, 1, 24), 1)] * 3 + [("c", date(2024, 1, 23), None)] * 4 + [("d", date(2024, 1, 31), 1)] * 9 + [("e", date(2022, 1, 1), 1)]
    df = spark.createDataFrame(rows, "key string, day date, bytes_sent bigint")
    top = R.popular_downloads(df, "2024-01-30", k=2)
    got = {(r.period, r["rank"]): (r.key, r.n, r.bytes) for r in top.collect()}
    assert got == {
        ("day", 1): ("a", 2, 10), ("week", 1): ("b", 3, 3), ("week", 2): ("a", 2, 10),
        ("month", 1): ("c", 4, 0), ("month", 2): ("b", 3, 3), ("year", 1): ("c", 4, 0), ("year", 2): ("b", 3, 3),
    }
    assert "WindowGroupLimit" in plan(top)
    assert not {"remote_ip", "remote_ipaddr", "user_agent"} & set(top.columns)


def test_size_classes_and_tags(spark):
    sizes = [None, 0, 999, 1000, 999_999, 1_000_000, 10**9, 10**12]
    df = spark.createDataFrame([(s, 1, '{"os": "w", "n": 2}' if s else None) for s in sizes], "object_size bigint, bytes_sent bigint, tags string")
    got = {r.size_class: r.n for r in R.downloads_by_size(df).collect()}
    assert got == {"unknown": 1, "under_1k": 2, "under_10k": 1, "under_1m": 1, "under_1g": 1, "1g_and_more": 2}
    assert {(r.tag, r.n) for r in R.downloads_by_tag(df, "os").collect()} == {("w", 6), (None, 2)}
    exported = R.export_catalog_json(df.select("object_size", "tags")).filter(F.col("json").contains("999999")).first()
    assert exported.json == '{"object_size":999999,"tags":"{\\"os\\": \\"w\\", \\"n\\": 2}"}'
