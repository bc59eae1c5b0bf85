"""Jobs that go on from where an earlier run has stopped."""

import os
import random

import pytest
from pyspark.sql import functions as F

from accesslake.operators import hashing as H
from accesslake.plans.corpus import hash_listing, hash_pending, hash_results
from accesslake.plans.merge import MergedLog
from accesslake.plans.store import Store
from accesslake.sources.listing import list_objects
from accesslake.sources.logs import scan_logs
from accesslake.sources.seen import SeenLines, first_rows
from accesslake.streaming import live as SL


@pytest.fixture
def logs(tmp_path, bucket):
    """Writes a folder of log files; each line is (day, second, key)."""

    def write(folder, **files):
        (tmp_path / folder).mkdir()
        for name, rows in files.items():
            text = [bucket(key=k, time=f"{d:02d}/Jan/2024:00:00:{s:02d} +0000") for d, s, k in rows]
            (tmp_path / folder / name).write_text("".join(t + "\n" for t in text))
        return str(tmp_path / folder)

    return write


def merged_keys(log):
    """Keys by day, in the order of the files as they lie on disk."""
    found = {}
    for day in sorted(d for d in os.listdir(f"{log.root}/log") if d.startswith("day=")):
        folder = f"{log.root}/log/{day}"
        text = "".join(open(f"{folder}/{f}").read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))
        found[day[-2:]] = [line.split()[8] for line in text.splitlines()]
    return found


def test_merging_more_files(spark, logs, tmp_path):
    log = MergedLog(f"{tmp_path}/merged", "bucket")
    assert log.merge(spark, logs("a", x=[(1, 5, "a5"), (2, 1, "b1"), (1, 3, "a3")], y=[(3, 9, "c9"), (1, 5, "a5y")])) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert merged_keys(log) == {"01": ["a3", "a5", "a5y"], "02": ["b1"], "03": ["c9"]}
    files = lambda day: {f: os.stat(f"{log.root}/log/day={day}/{f}").st_mtime_ns for f in os.listdir(f"{log.root}/log/day={day}")}
    before = {d: files(d) for d in log.days(spark)}
    new = logs("b", w=[(2, 0, "b0"), (2, 1, "b1"), (2, 1, "b1late"), (2, 1, "b1late"), (5, 1, "e1")])
    assert log.merge(spark, new) == ["2024-01-02", "2024-01-05"]
    want = {"01": ["a3", "a5", "a5y"], "02": ["b0", "b1", "b1late"], "03": ["c9"], "05": ["e1"]}
    assert merged_keys(log) == want
    assert all(files(d) == before[d] for d in ("2024-01-01", "2024-01-03")) and files("2024-01-02") != before["2024-01-02"]
    log.merge(spark, new)
    log.stage(spark, new)
    log.journal.finish(spark)
    assert merged_keys(log) == want and not log.journal.pending(spark)
    assert log.merge(spark, logs("none")) == [] and log.merge(spark, logs("old", z=[(9, 1, "i1")]), year=2020) == []
    assert merged_keys(log) == want


def test_merging_one_by_one_is_merging_at_once(spark, logs, tmp_path):
    r = random.Random(8)
    parts = [[(r.randrange(1, 5), r.randrange(60), f"k{r.randrange(40)}") for _ in range(60)] for _ in range(3)]
    one, all_ = MergedLog(f"{tmp_path}/one", "bucket"), MergedLog(f"{tmp_path}/all", "bucket")
    for i, p in enumerate(parts):
        one.merge(spark, logs(f"p{i}", **{f"f{i}": p}))
    all_.merge(spark, [f"{tmp_path}/p{i}" for i in range(3)])
    # of lines of one instant, those of an earlier merge come first, as those of an earlier file do
    assert merged_keys(one) == merged_keys(all_) and sum(map(len, merged_keys(one).values())) > 100


def test_lines_seen_in_earlier_runs(spark, logs, tmp_path):
    seen = SeenLines(f"{tmp_path}/seen")
    keys = lambda rows: sorted((r.line.split()[8], r.n) for r in rows.collect())
    first = logs("a", x=[(1, 1, "a"), (1, 1, "a"), (1, 2, "b")], y=[(1, 1, "a")])
    second = logs("b", z=[(1, 1, "a"), (1, 3, "c"), (1, 3, "c")])
    assert keys(seen.take(scan_logs(spark, first), 0)) == [("a", 3), ("b", 1)]
    for _ in range(2):
        assert keys(seen.take(scan_logs(spark, second), 1)) == [("c", 2)]
    assert keys(seen.take(scan_logs(spark, [first, second]), 2)) == []
    seen.compact(spark)
    assert seen.before(spark, 3).count() == 3
    assert keys(seen.take(scan_logs(spark, logs("c", z=[(1, 3, "c"), (1, 4, "d")])), 3)) == [("d", 1)]
    with pytest.raises(ValueError):
        seen.before(spark, 1)


def test_no_line_is_a_key_of_a_shuffle(spark, tmp_path, plan):
    staged = spark.createDataFrame([("l", bytearray(16), 1)], "line string, digest binary, row_id long")
    staged.write.parquet(f"{tmp_path}/staged")
    grouped = plan(first_rows(spark.read.parquet(f"{tmp_path}/staged")))
    assert "HashAggregate" in grouped and "SortAggregate" not in grouped
    assert "ReadSchema: struct<digest:binary,row_id:bigint>" in grouped


def objects(spark, *sizes):
    rows = [(f"k{i}", f"file:///k{i}", f"e{i}", size) for i, size in enumerate(sizes)]
    return spark.createDataFrame(rows, "s3key string, uri string, etag string, bytes long").withColumn("mtime", F.lit(None).cast("timestamp"))


def test_objects_are_dealt_by_size(spark):
    big, task = 10 << 20, 1 << 20
    r = random.Random(3)
    sizes = [big, big, *[r.randrange(200_000) for _ in range(300)], *[0] * 300]
    dealt, slots = H.deal_by_size(objects(spark, *sizes), task)
    rows = dealt.collect()
    assert len(rows) == len(sizes) and all(0 <= x.slot < slots for x in rows)
    slot = {}
    for x in rows:
        slot.setdefault(x.slot, []).append(x.bytes)
    assert sum(big in s for s in slot.values()) == 2 and all(s.count(big) <= 1 for s in slot.values())
    for s in slot.values():
        small = [x for x in s if x != big]
        assert sum(small) + H.OBJECT_COST * len(small) <= task + 200_000 + H.OBJECT_COST
    assert max(s.count(0) for s in slot.values()) <= task // H.OBJECT_COST + 1
    none, slots = H.deal_by_size(objects(spark).limit(0), task)
    assert none.count() == 0 and slots == 1


def test_each_slot_is_a_task(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f{i}").write_bytes(b"x" * 3000)
    dealt, slots = H.deal_by_size(list_objects(spark, str(tmp_path)), 3000 + H.OBJECT_COST)
    hashed = H.hash_dealt(dealt, 0, slots)
    assert hashed.rdd.getNumPartitions() == slots >= 4
    by_task = hashed.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in by_task) == 6 and max(r["count"] for r in by_task) <= 2


def test_a_hash_job_that_was_killed_goes_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("accesslake.plans.corpus.SLICE_WAVES", 1)
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"f{i}").write_bytes(bytes([i]) * 70_000)
    store, listing = Store(f"{tmp_path}/store"), list_objects(spark, str(tmp_path / "in"))
    hash_listing(spark, store, listing, task_bytes=1 << 17, slices=1)
    first = {r.s3key for r in hash_results(spark, store).collect()}
    assert 0 < len(first) < 40 and store.catalog(spark).count() == 0
    os.makedirs(f"{store.root}/hashed/slice=1")  # a slice that was not written to its end
    for key in first:
        os.remove(tmp_path / "in" / key)
    results = hash_listing(spark, store, listing, task_bytes=1 << 17)
    assert {r.s3key for r in results.collect()} == {f"f{i}" for i in range(40)} and results.filter("error is not null").count() == 0
    assert store.catalog(spark).filter("sha3_256 is not null").count() == 40
    assert hash_results(spark, store).count() == 0


def test_small_objects_take_a_bounded_number_of_slices(spark, tmp_path, monkeypatch):
    """Slices grow with the job, each in a fixed number of tasks, up to their bytes; a killed job still goes on."""
    monkeypatch.setattr("accesslake.plans.corpus.SLICE_WAVES", 1)
    monkeypatch.setattr("accesslake.plans.corpus.MOST_SLICES", 3)
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"f{i}").write_bytes(bytes([i]) * 70_000)
    store, listing = Store(f"{tmp_path}/store"), list_objects(spark, str(tmp_path / "in"))
    tasks = []
    monkeypatch.setattr("accesslake.plans.corpus.hash_dealt", lambda *x: (found := H.hash_dealt(*x), tasks.append(found.rdd.getNumPartitions()))[0])
    hash_pending(spark, store, listing, task_bytes=1 << 17, slices=1)
    first = {r.s3key for r in hash_results(spark, store).collect()}
    assert 10 <= len(first) <= 16
    for key in first:
        os.remove(tmp_path / "in" / key)
    hash_pending(spark, store, listing, task_bytes=1 << 17)
    whole = hash_results(spark, store)
    assert sorted(r.s3key for r in whole.collect()) == sorted(f"f{i}" for i in range(40)) and whole.filter("error is not null").count() == 0
    assert 3 <= len(os.listdir(f"{store.root}/hashed")) <= 4 + 1 and max(tasks) <= 4
    other = Store(f"{tmp_path}/other")
    monkeypatch.setattr("accesslake.plans.corpus.SLICE_BYTES", 6 << 17)
    hash_pending(spark, other, listing, task_bytes=1 << 17)
    assert 7 <= len(os.listdir(f"{other.root}/hashed")) <= 8 and hash_results(spark, other).count() == 40


def test_folded_changes(spark, tmp_path):
    path = f"{tmp_path}/changes"

    def batch(number, **values):
        spark.createDataFrame(list(values.items()), "k string, v long").write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    latest = lambda: SL.latest_values(spark, path, ["k"], "v")
    batch(0, a=1, b=1)
    batch(1, a=2)
    assert SL.compact_changes(spark, path, ["k"], "v") == 2 and SL.compact_changes(spark, path, ["k"], "v") == 2
    batch(2, b=7, c=3)
    assert dict(latest().collect()) == {"a": 2, "b": 7, "c": 3}
    read = latest().inputFiles()
    assert not [f for f in read if "batch_id=0" in f or "batch_id=1" in f]
    assert SL.compact_changes(spark, path, ["k"], "v", drop=True) == 3
    assert os.listdir(path) == [] and dict(latest().collect()) == {"a": 2, "b": 7, "c": 3}
    batch(3, a=9)
    assert dict(latest().collect()) == {"a": 9, "b": 7, "c": 3}
    with pytest.raises(ValueError):
        SL.latest_values(spark, f"{tmp_path}/nothing", ["k"], "v")
