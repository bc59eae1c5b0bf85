import hashlib
import random
import re
from zlib import crc32

import pytest

from accesslake.llm.queries import QUERIES
from accesslake.llm.runs import collapsed, periodic_runs, planted, runs_of, strongest


def brute_force(words):
    """Every stretch of every period that no neighbour extends; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - start
            if stop > start and length >= max(24, 3 * q):
                found.setdefault((start, length), q)
            start = max(stop, start + 1)
    return sorted([(s, length, q) for (s, length), q in found.items()], key=lambda r: (r[0], r[2]))


def mixtures(seed, n):
    """Words from few letters, with periodic parts."""
    r = random.Random(seed)
    for _ in range(n):
        words = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randrange(200))]
        for _ in range(r.randrange(4) if len(words) > 10 else 0):
            at, period = r.randrange(len(words)), r.randrange(1, 40)
            for i in range(at, min(len(words), at + r.randrange(160))):
                words[i] = words[at + (i - at) % period]
        yield words


def test_runs_equal_brute_force():
    assert sum([len(brute_force(w)) for w in mixtures(3, 1500)]) > 400
    for words in mixtures(3, 1500):
        assert runs_of(words) == brute_force(words)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 31, 32, 33, 500])
def test_a_run_of_each_period(period):
    words = ["x", "y", *[f"w{i % period}" for i in range(max(24, 3 * period))], "z"]
    assert runs_of(words) == [(2, max(24, 3 * period), period)]
    short = words[:-2] + ["z"]
    assert runs_of(short) == []


def test_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert runs_of(list(b)) == brute_force(list(b))


def test_long_texts_stay_cheap():
    assert runs_of(["a", "b", "c", "d"] * 50_000) == [(0, 200_000, 4)]


def test_strongest_and_collapsed():
    assert strongest([(5, 30, 10), (9, 24, 8), (40, 60, 20)]) == (5, 30, 10)
    assert strongest([]) is None
    words = ["x", *["a", "b"] * 12, "y"]
    assert collapsed(words, runs_of(words)) == "x a b y"


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_force(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = best and 1000 * best[1] // best[2]
    return (doc_id, len(runs), *(best or (None,) * 3), milli, digest(listed), digest(kept))


def test_query_equals_brute_force(spark):
    """Of the given texts those of up to 400 words, which are all but the longest."""
    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, path).collect()
    assert len(rows) == len(docs)
    short = [r for r in rows if len((docs[r.doc_id] or "").split()) <= 400]
    assert len(short) > 100 and sum(r.n_runs for r in short) > 5
    assert [tuple(r) for r in short] == [expected(r.doc_id, docs[r.doc_id]) for r in short]


def test_odd_rows(spark, odd, none):
    found = periodic_runs(odd, plant=True).collect()
    assert len(found) == odd.count()
    of = {r.doc_id: r for r in found if r.doc_id is not None}
    assert (of[2].runs, of[3].runs, of[6].runs, of[2].strongest, of[2].collapsed, of[3].collapsed) == ([], [], [], None, "", "")
    assert [tuple(r) for r in of[4].runs] == [(0, 80_000, 4)] and of[4].collapsed == "alpha beta gamma delta"
    assert planted(["a"] * 50, None) == ["a"] * 50
    assert periodic_runs(none).collect() == []


def test_equal_rows_give_equal_results(spark):
    text = " ".join(["a", "b", "c"] * 9)
    rows = periodic_runs(spark.createDataFrame([(7, text), (7, text), (None, text)], "doc_id long, text string")).collect()
    assert [[tuple(x) for x in r.runs] for r in rows] == [[(0, 27, 3)]] * 3
