"""Near duplicates, decontamination, conversations and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from accesslake.llm import chat, decontam, neardup
from accesslake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = SPACED.findall((t or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_classes(rows):
    """Component of each row by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    where, up = {}, list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where.get(x, ()))
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
        for x in s:
            where.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = root(i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def got_classes(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame).collect())


def test_near_duplicates_equal_brute_force(spark, odd, none):
    for frame in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        assert got_classes(frame) == Counter(brute_classes([(r.doc_id, r.text) for r in frame.collect()]))
    assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("edits", [(0, 2), (2, 5)])
def test_near_duplicates_of_large_groups(spark, edits):
    """A group of near copies far above a node's size, pairs near the threshold, and texts that share a passage."""
    rnd = random.Random(edits[1])
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    base, passage, rows = [word() for _ in range(150)], [word() for _ in range(60)], []
    for i in range(150):
        copy = list(base)
        for _ in range(rnd.randint(*edits)):
            copy[rnd.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy)))
    for i in range(150, 260):
        rows.append((i, " ".join(passage + [word() for _ in range(rnd.choice((5, 8, 60)))])))
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_classes(frame) == Counter(brute_classes(rows))


@pytest.mark.parametrize("count, words, edits", [(1000, 230, (2, 4)), (600, 200, (2, 3))])
def test_no_link_of_a_large_group_is_lost(spark, monkeypatch, count, words, edits):
    """Distinct near copies with a mean similarity below the threshold: classes equal those of all pairs, across blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 256)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 30_000)
    rnd = random.Random(count)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base, rows = [word() for _ in range(words)], []
    for i in range(count):
        copy = list(base)
        for at in rnd.sample(range(4, words - 4), rnd.randint(*edits)):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    want = brute_classes(rows)
    assert len({c for _, _, c in want}) > 10
    assert got_classes(spark.createDataFrame(rows, "doc_id long, text string")) == Counter(want)


def test_components_of_long_paths(spark):
    rnd = random.Random(1)
    names = [bytes([i // 256, i % 256]) for i in range(300)]
    rnd.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(149)] + [(names[200], names[i]) for i in range(201, 300)]
    rows = neardup.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    label = {bytes(r.v): bytes(r.label) for r in rows}
    assert {label[n] for n in names[:150]} == {min(names[:150])}
    assert {label[n] for n in names[200:]} == {min(names[200:])} and len(label) == 250


@pytest.mark.parametrize("small", [0, 100_000])
def test_links_found_later_join_the_components_of_earlier_ones(spark, monkeypatch, small):
    """Labels equal those of all links at once, whether they are sent to every task or shuffled."""
    monkeypatch.setattr(neardup, "GRAPH_LINKS", small)
    rnd = random.Random(2)
    name = lambda i: bytes([i // 256, i % 256])
    pairs = [tuple(sorted((name(rnd.randrange(400)), name(rnd.randrange(400))))) for _ in range(260)]
    pairs = [p for p in pairs if p[0] != p[1]]
    made = lambda links: spark.createDataFrame(links, "a binary, b binary")
    rows = lambda labels: Counter((bytes(r.v), bytes(r.label)) for r in labels.collect())
    first, rest = made(pairs[:120]), made(pairs[120:] + pairs[:3])
    labels = neardup.components(first)
    want = rows(neardup.components(made(pairs)))
    assert rows(neardup.joined(labels, rest)) == want and len({label for _, label in want}) > 20
    assert rows(neardup.joined(labels, made(pairs[:5]))) == rows(labels)
    assert rows(neardup.joined(labels, made([]))) == rows(labels)
    assert rows(neardup.components(made([]))) == Counter()


def test_components_store_one_table_a_round(spark, monkeypatch):
    """What is stored and shuffled over many partitions costs time by the table, however small the links."""
    stored, stage = [], neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, label: stored.append(label) or stage(df, label))
    hub = bytes([255])
    links = spark.createDataFrame([(bytes([i]), hub) for i in range(40)], "a binary, b binary")
    assert {(bytes(r.v), bytes(r.label)) for r in neardup.components(links).collect()} == {(v, bytes([0])) for v in [*(bytes([i]) for i in range(40)), hub]}
    assert len(stored) <= 3


def test_links_that_join_are_confirmed_on_full_sets(spark):
    """Pairs of one block against all pairs: a forest of its links, whose classes are those of all links."""
    import numpy as np
    import pandas as pd

    rng, rnd, rows = np.random.default_rng(3), random.Random(3), []
    factors, base = neardup.coordinates(), rng.integers(0, 1 << 62, 120).astype(np.uint64)
    for i in range(60):
        own = base.copy()
        own[rnd.sample(range(120), rnd.randint(3, 9))] = rng.integers(0, 1 << 62, 1).astype(np.uint64)
        own = np.unique(own)
        tokens = neardup.minwise(own, factors)
        bits = np.packbits((neardup.mix(tokens) & np.uint64(1)).astype(np.uint8)).view(np.int64)
        ends = (neardup.mix(tokens) >> np.uint64(33)).astype(np.uint8).tobytes()
        rows.append((9, bytes([i]), len(own), int(bits[0]), int(bits[1]), i, ends, [9] * neardup.TREES, own.view(np.int64), 0, 0, 0))
    frame = pd.DataFrame(rows, columns=["node", "v", "n", "s1", "s2", "mark", "ends", "nodes", "shingles", "block", "i", "j"])
    sets = [set(x.tolist()) for x in frame["shingles"]]
    linked = {(i, k) for i in range(60) for k in range(i + 1, 60) if 100 * len(sets[i] & sets[k]) >= 85 * len(sets[i] | sets[k])}
    got = [(a[0], b[0]) for a, b in neardup.joining_links(frame).itertuples(index=False)]
    assert got and set(got) <= linked

    def classes(pairs):
        up = list(range(60))
        for _ in range(60):
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        return up

    assert classes(got) == classes(linked) and len(got) == 60 - len(set(classes(linked)))


def test_dropping_near_duplicates(spark, odd, odd_rows):
    left = neardup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    texts = Counter(r.text for r in left.collect())
    assert texts == Counter({t for _, t, *_ in odd_rows if t and SPACED.search(t)} | {None, "", "  \n\t \x0b"}) + Counter([None])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {c for _, _, c in brute_classes([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id for r in neardup.drop_near_duplicates(docs).select("doc_id").collect()} == want


def brute_hits(docs, items):
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        for s in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[s : s + 10]), set()).add("" if i is None else str(i))
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                got = windows.get(tuple(w[s : s + n]))
                if got:
                    hit.update(range(s, s + n))
                    found |= got
        out.append((d, len(w), len(hit), ",".join(sorted(found))))
    return out


def test_decontamination_equals_brute_force(spark, odd, none):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    rows = QUERIES["op9_decontamination"](spark, SF).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in rows) == Counter((d, n, h, sha(i)) for d, n, h, i in want)
    assert any(h for _, _, h, _ in want) and all(r.contaminated == (r.n_hit > 0) for r in rows)
    items = [(1, "two three four"), (1, "Three"), (None, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma"), (9, None), (8, "--"), (7, "two three four"), (7, "two three four")]
    own = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(odd, own).collect()
    want = brute_hits([(r.doc_id, r.text) for r in odd.collect()], items)
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in found) == Counter(want)
    left = decontam.drop_contaminated(odd, own)
    assert left.columns == odd.columns and left.count() == sum(h == 0 for _, _, h, _ in want)
    assert decontam.contamination(none, own).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(odd, own.limit(0)).collect())


def test_many_terms_are_looked_up_in_slices(spark, monkeypatch):
    bench, docs = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = Counter((r.doc_id, r.n_hit) for r in decontam.contamination(docs, bench).collect())
    monkeypatch.setattr(decontam, "MAX_TERMS", 300)
    assert Counter((r.doc_id, r.n_hit) for r in decontam.contamination(docs, bench).collect()) == whole


def test_proximity(spark, texts):
    bench = spark.createDataFrame([(1, "red green blue white black")], "item_id long, text string")
    docs = texts("red one green two", "red " + "x " * 50 + "green", "blue")
    aligned, _ = decontam.alignment_tables(docs, bench, "doc_id", "text", "item_id", 2)
    near = {r.doc_id for r in decontam.proximity_matches(aligned, 5).collect()}
    assert near <= {0}


def brute_chat(rows):
    by = {}
    for c, n, role, text in set(rows):
        by.setdefault(c, []).append((n is not None, n or 0, role is not None, role or "", text is not None, text or ""))
    full = {c: tuple(sorted(v)) for c, v in by.items()}
    longest = {}
    for c, v in full.items():
        for k in range(1, len(v)):
            longest.setdefault(v[:k], True)
    first = {}
    for c, v in full.items():
        if v not in first or (c is not None and (first[v] is None or c < first[v])):
            first[v] = c
    return {c: "".join(f"<|{x[3]}|>\n{x[5]}<|end|>\n" for x in v) for v, c in first.items() if v not in longest}


def test_conversations_equal_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute_chat([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    rows = QUERIES["op10_chat_format"](spark, SF).collect()
    assert {r.conv_id: r.rendered for r in rows} == want


def test_odd_conversations(spark, monkeypatch):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, None, None),
             (4, 1, "user", ""), (5, 0, "", ""), (None, 0, "user", "z"), (None, None, "user", "y"), (6, 0, "user", "q" * 100_000), (7, 0, None, None)]
    turns += [(8, i, "user", str(i)) for i in range(25)] + [(9, i, "user", str(i)) for i in range(12)]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(turns, schema).selectExpr("*", "1 as n", "'x' as h1", "2 as block")
    monkeypatch.setattr(chat, "BLOCK", 10)
    found = chat.format_conversations(frame).collect()
    joined = {}
    for r in sorted(found, key=lambda r: r.part):
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.rendered
    assert joined == brute_chat(turns)
    assert [(r.part, r.n_parts, r.n_turns) for r in sorted(found, key=lambda r: r.part) if r.conv_id == 8] == [(0, 3, 10), (1, 3, 10), (2, 3, 5)]
    far = spark.createDataFrame([(1, t, "user", "x") for t in (999, 1000, 2000)], schema)
    assert [(r.part, r.n_parts, r.n_turns) for r in chat.format_conversations(far).collect()] == [(0, 1, 3)]
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frame, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        seen[name] = {r.doc_id: r for r in frame.collect()}
        assert frame.count() == len(seen[name])
        if name != "sentencepiece":
            assert frame.columns == docs.columns
    raw = {r.doc_id: r for r in docs.collect()}
    good, unique, clean, safe, done = seen.values()
    assert set(done) == set(safe) == set(clean) <= set(unique) <= set(good) <= set(raw)
    want = {c for _, _, c in brute_classes([(i, good[i].text) for i in good])}
    assert set(unique) == want
    hits = {d: h for d, _, h, _ in brute_hits([(i, unique[i].text) for i in unique], [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])}
    assert set(clean) == {i for i in unique if not hits[i]}
    for i, r in safe.items():
        assert r.n_chars == len(r.text) and (r.text == clean[i].text or "[SECRET]" in r.text)
        assert not re.search(r"(?i:password)=[0-9a-f]{6}|AKIA[A-Z0-9]{16}", r.text)
    assert Counter(r.n_tokens for r in corpus_pipeline.run(spark, sf).collect()) == Counter(r.n_tokens for r in done.values())
