import hashlib
import random
import re
from functools import lru_cache
from itertools import groupby
from zlib import crc32

import pytest

from accesslake.llm.queries import QUERIES
from accesslake.llm.repair import repair_conversations, repaired_turns

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """The fault of each (role, text) row in order, by what the contract says."""
    seen, found = set(), []
    for role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        if not letters:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit, turns) from the last row to the first: the rest after a choice does not depend on what came before."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def rest(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for x in set(follows[state]) - {"s"}:
                c, audit, kept = rest(i, x, inserted + 1)
                options.append((c + 3, "I" + audit, (f"{full[x]}:", *kept)))
        if i < len(rows):
            role, text = rows[i]
            c, audit, kept = rest(i + 1, state, 0)
            options.append((c + 4, "D" + audit, kept))
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] == "truncated" else 0
                if role[:1] and role[:1] in follows[state]:
                    c, audit, kept = rest(i + 1, role[:1], 0)
                    options.append((c + more, "K" + audit, (f"{role}:{text}", *kept)))
                for x in set(follows[state]) - {"s"}:
                    c, audit, kept = rest(i + 1, x, 0)
                    options.append((c + more + 3, "R" + audit, (f"{full[x]}:{text}", *kept)))
        return min(options, default=(10**9, "", ()))

    return rest(0, "", 0)


def expected(rows, damage):
    """What one conversation of (turn, role, text) rows gives; ``damage`` is its id, or None for undamaged rows."""
    blank = lambda x: " " if x is None else x
    kept = []
    for turn, role, text in rows:
        role, text = blank(role), blank(text)
        part = crc32(f"{damage}:{blank(turn)}".encode()) % 20 if damage is not None else None
        if part == 0:
            continue
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        role = "user" if part == 4 else role
        kept += [(turn, role, text)] * (2 if part == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    pairs = [(r, t) for _, r, t in kept]
    found = faults(pairs)
    numbers = {t for t, _, _ in kept if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    cost, audit, turns = cheapest(tuple(pairs), tuple(found))
    digest = hashlib.sha256("\n".join(turns).encode()).hexdigest()
    return (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest), turns


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    for conv in range(n):
        roles = r.choice([["user", "assistant"], ["user", "assistant", "system"], ["user"], ["user", "assistant", "system", "tool", "", None, "a", "ux"]])
        texts = ["Yes.", "No!", "cut", "  \n", "", None, "So? ", "é.", "Yes. ", *[f"text {i}." for i in range(20)]]
        turns = [r.choice([None, 0, 1, 2, 3, 5, 8, 13, -4]) if r.random() < 0.3 else i for i in range(r.randrange(1, longest))]
        for t in turns:
            yield conv, t, r.choice(roles), r.choice(texts)


def by_conversation(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return {conv: [r[1:] for r in own] for conv, own in groupby(rows, key=lambda r: r[0])}


@pytest.mark.parametrize("damage", [False, True])
def test_repair_equals_brute_force(spark, damage):
    rows = list(conversations(5, 400))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair_conversations(frame, damage=damage).collect()}
    assert found == {conv: expected(own, conv if damage else None)[0] for conv, own in by_conversation(rows).items()}
    assert len({r[6] for r in found.values()}) > 100


def test_repaired_turns_are_those_of_the_digest(spark):
    rows = list(conversations(6, 200))
    frame = spark.createDataFrame(rows, SCHEMA)
    repairs = repair_conversations(frame)
    found = by_conversation([tuple(r) for r in repaired_turns(frame, repairs).orderBy("conv_id", "place").collect()])
    for conv, own in by_conversation(rows).items():
        turns = [f"{role}:{text}" for _, role, text in found.get(conv, [])]
        assert turns == list(expected(own, None)[1])
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in turns))


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_pointers_in_chunks(spark, chunk):
    """Conversations longer than a chunk leave their pointers as rows; results are the same."""
    rows = list(conversations(7, 60, longest=30)) + [(999, i, "user", f"t{i}.") for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(repair_conversations(frame, damage=True).collect(), key=lambda r: r.conv_id)
    assert sorted(repair_conversations(frame, damage=True, chunk=chunk).collect(), key=lambda r: r.conv_id) == whole
    assert [len(r.audit) > 100 for r in whole if r.conv_id == 999] == [True]


def test_a_conversation_over_many_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i // 3}.") for i in range(60)] + [(2, 0, "system", "s.")]
        found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {c: expected(own, None)[0] for c, own in by_conversation(rows).items()}


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_conversation_repair"](spark, path).collect()}
    assert found == {conv: expected(own, conv)[0] for conv, own in by_conversation(rows).items()}
    assert sum(r[5] for r in found.values()) > 0


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, kind int, digest string, audit long"
    empty = spark.createDataFrame([], schema)
    assert repair_conversations(empty, damage=True).collect() == []
    long = "x" * 300_000 + "."
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (3, 0, "user", long), (3, 1, "assistant", long),
        (4, None, "user", "a."), (4, None, "user", "a."), (4, 2, "user", "a."),
    ]
    frame = spark.createDataFrame([(*r, "c", 0, "d", 9) for r in rows], schema)
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair_conversations(frame).collect()}
    assert found == {c: expected(own, None)[0] for c, own in by_conversation(rows).items()}
    assert found[None][1:3] == (1, 1) and found[4][:3] == (0, 0, 2)


def test_all_rows_dropped(spark):
    """crc32 of "conv:turn" is a multiple of 20 for these."""
    gone = [c for c in range(200) if crc32(f"{c}:0".encode()) % 20 == 0]
    frame = spark.createDataFrame([(c, 0, "user", "Hi.") for c in gone], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r) for r in repair_conversations(frame, damage=True).collect()) == [(c, 0, 0, 0, 0, 0, 0, "", nothing) for c in gone]
