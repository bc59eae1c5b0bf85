"""Conversations whose turns do not alternate, or are blank, repeated or cut off: the cheapest repair of each.

Rows are repartitioned by conversation and sorted by turn, and one pass of mapInPandas carries the state of a dynamic
program over them, across Arrow batches. A repaired conversation is empty or an optional system turn and then user and
assistant in turn; its states are START, SYSTEM, USER (an assistant has to follow) and WHOLE. For each state
the program holds the least cost, the order of the edits among those of the other states, and the digest of the turns repaired so far.
What is kept of a row is a byte for each state: the state before, the turns inserted and the edit. Every CHUNK rows
these bytes leave as a row of the output, so that a task holds no more of them whatever the length of a conversation; for those
few conversations a second pass goes through the stored bytes from the last to the first and gives the edits.

Edits are Keep (cost 0), Rerole to user or assistant (3), Delete (4) and Insert of an empty user or assistant turn (3). Blank
and repeated rows have to be deleted; a row that is cut off and stays adds 3. Of repairs of one cost that with the
least string of edit initials is taken. Given that string, states and so roles follow, as each state allows one role to
be inserted or given. Two strings that have consumed the same rows are equal or differ at some place up to the last row's edit,
so their order is known by their ranks and the letters added.

A row's first fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated (its last character that is no
space is none of .!?). What was seen at an earlier turn is found by grouping digests, and sent along as marks, so no task
remembers the texts of a conversation.

Rows of one turn are taken by role and text. A null turn comes before all others, with the smallest long; nulls in role or text are one space; rows
without a conversation id are one conversation, and keep the null. A row with an empty role has no initial and can only be
reroled or deleted. An empty table gives no rows, and a conversation without rows zeros and an empty audit. Repeated
rows are repeated turns. Other columns are not read. A conversation with a large share of all rows is streamed by one task, in
bounded memory.
"""

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import stage

START, SYSTEM, USER, WHOLE = range(4)
KEEP, REROLE, DELETE = range(3)
LETTERS = "KRD"
INSERT = "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: (state, initial) -> state of a kept turn; the role that each state takes next; its state then.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (WHOLE, "u"): USER, (USER, "a"): WHOLE}
NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", WHOLE: "user"}
NEXT_STATE = {START: USER, SYSTEM: USER, USER: WHOLE, WHOLE: USER}
#: Turns to insert at the end, by state.
MISSING = {START: 0, SYSTEM: 2, USER: 1, WHOLE: 0}
GOOD, TRUNCATED, BLANK, DUPLICATE = range(4)
LEGAL = ("su", "ua", "au")
NO_TURN = -(1 << 63)
CHUNK = 1 << 16
UNREACHED = 255
SPACES = " \t\n\x0b\x0c\r"

STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
STREAMED = f"conv string, chunk long, last boolean, pointers binary, state int, {STATS}"


def moves(initial: str, fault: int) -> list[tuple[int, int, int, str, int, int]]:
    """(state before, state after, cost, letters, turns inserted, edit) by which a row can be taken."""
    found = []
    for before in range(4):
        at = before
        for inserted in range(3):
            if inserted == 2 and at == before:
                break
            cost, prefix = INSERT_COST * inserted, INSERT * inserted
            found.append((before, at, cost + DELETE_COST, prefix + LETTERS[DELETE], inserted, DELETE))
            if fault in (GOOD, TRUNCATED):
                cost += TRUNCATED_COST if fault == TRUNCATED else 0
                if (at, initial) in KEPT:
                    found.append((before, KEPT[at, initial], cost, prefix + LETTERS[KEEP], inserted, KEEP))
                found.append((before, NEXT_STATE[at], cost + REROLE_COST, prefix + LETTERS[REROLE], inserted, REROLE))
            at = NEXT_STATE[at]
    return found


MOVES = {(i, f): moves(i, f) for i in ("s", "u", "a", "") for f in (GOOD, TRUNCATED, BLANK)}


class Repair:
    """The program's state over one conversation."""

    def __init__(self) -> None:
        #: (cost, rank of the edits, digest, whether it has turns) by state.
        self.survivors: list[tuple | None] = [(0, 0, sha256(), False), None, None, None]
        self.pointers = bytearray()

    def step(self, role: str, text: str, fault: int) -> None:
        """Take the next row."""
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        best: list[tuple | None] = [None] * 4
        survivors = self.survivors
        for before, after, cost, letters, inserted, edit in MOVES[initial, min(fault, BLANK)]:
            own = survivors[before]
            if own is not None:
                key = (own[0] + cost, own[1], letters, before, inserted, edit)
                if best[after] is None or key < best[after]:
                    best[after] = key
        ranks = {core: i for i, core in enumerate(sorted({b[1:3] for b in best if b is not None}))}
        kept: list[tuple | None] = [None] * 4
        for after, b in enumerate(best):
            if b is None:
                self.pointers.append(UNREACHED)
                continue
            cost, rank, letters, before, inserted, edit = b
            self.pointers.append(before | inserted << 2 | edit << 4)
            _, _, digest, some = survivors[before]
            if inserted or edit != DELETE:
                digest = digest.copy()
                state = before
                for _ in range(inserted):
                    digest.update(f"\n{NEXT_ROLE[state]}:".encode() if some else f"{NEXT_ROLE[state]}:".encode())
                    state, some = NEXT_STATE[state], True
                if edit != DELETE:
                    turn = f"{role if edit == KEEP else NEXT_ROLE[state]}:{text}"
                    digest.update((f"\n{turn}" if some else turn).encode("utf-8", "surrogatepass"))
                    some = True
            kept[after] = (cost, ranks[rank, letters], digest, some)
        self.survivors = kept

    def finish(self) -> tuple[int, int, str]:
        """Cost, last state and digest of the best repair."""
        ends = []
        for state, own in enumerate(self.survivors):
            if own is not None:
                missing = MISSING[state]
                ends.append((own[0] + INSERT_COST * missing, own[1], INSERT * missing, state))
        cost, _, added, state = min(ends)
        _, _, digest, some = self.survivors[state]
        at = state
        for _ in added:
            digest.update(f"\n{NEXT_ROLE[at]}:".encode() if some else f"{NEXT_ROLE[at]}:".encode())
            at, some = NEXT_STATE[at], True
        return cost, state, digest.hexdigest()


def trace(pointers: bytes, state: int) -> tuple[str, int]:
    """Edits of the rows whose pointers are given, from the state after them; and the state before them."""
    letters = []
    for at in range(len(pointers) - 4, -1, -4):
        p = pointers[at + state]
        state, inserted, edit = p & 3, p >> 2 & 3, p >> 4
        letters.append(INSERT * inserted + LETTERS[edit])
    return "".join(reversed(letters)), state


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conv, turn, role, text with planted faults, by a hash of conversation and turn; ``dropped`` rows have neither role nor text."""
    part = F.crc32(F.concat(F.coalesce("conv", F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.when(part == 1, F.lit("")).when(part == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(part == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(part == 3, 2).otherwise(1)))
    changed = rows.select("conv", "turn", role.alias("role"), text.alias("text"), (part == 0).alias("dropped"), copies.alias("_copy"))
    blank = lambda c: F.when(F.col("dropped"), F.lit("")).otherwise(F.col(c))
    return changed.withColumns({"role": blank("role"), "text": blank("text")}).drop("_copy")


def turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, damage: bool) -> DataFrame:
    """(conv, turn, role, text, dropped) as the repair takes them; conv is text, and a null turn the smallest long."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(conv_id).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), own(role).alias("role"), own(text).alias("text")
    )
    rows = damaged(rows) if damage else rows.withColumn("dropped", F.lit(False))
    return rows.withColumn("turn", F.coalesce("turn", F.lit(NO_TURN).cast("long")))


def digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def seen_marks(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest) of turns whose role and text an earlier turn of the conversation has."""
    light = rows.filter(~F.col("dropped")).select("conv", "turn", digest(F.col("role"), F.col("text")).alias("digest"))
    spans = light.groupBy("conv", "digest").agg(F.min("turn").alias("first"), F.max("turn").alias("last")).filter("first < last")
    again = light.alias("r").join(
        spans.alias("s"), F.col("r.conv").eqNullSafe(F.col("s.conv")) & (F.col("r.digest") == F.col("s.digest")) & (F.col("r.turn") > F.col("s.first"))
    )
    return again.select("r.conv", "r.turn", "r.digest").distinct()


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with the marks of what was seen earlier ahead of each turn, sorted by turn within whole conversations."""
    own = rows.select("conv", "turn", F.lit(1).alias("kind"), "role", "text", digest(F.col("role"), F.col("text")).alias("digest"), "dropped")
    marks = seen_marks(rows).select(
        "conv", "turn", F.lit(0).alias("kind"), F.lit("").alias("role"), F.lit("").alias("text"), "digest", F.lit(False).alias("dropped")
    )
    return own.unionByName(marks).repartition("conv").sortWithinPartitions("conv", "turn", "kind", "role", "text")


class Stream:
    """A conversation as it goes by: its faults, and the repair."""

    def __init__(self, conv: str | None, chunk: int = CHUNK) -> None:
        self.conv, self.size, self.repair = conv, chunk, Repair()
        self.counts, self.illegal = [0] * 4, 0
        self.first: int | None = None
        self.turn: int | None = None
        self.numbers = self.chunks = 0
        self.marks: set[bytes] = set()
        self.before: tuple | None = None

    def take(self, turn: int, kind: int, role: str, text: str, digest: bytes, dropped: bool) -> None:
        if turn != self.turn:
            self.turn = turn
            self.marks, self.counted = set(), False
        if not kind:
            self.marks.add(bytes(digest))
            return
        if dropped:
            return
        if turn != NO_TURN and not self.counted:
            self.first = turn if self.first is None else self.first
            self.last, self.counted = turn, True
            self.numbers += 1
        here = (turn, role, text)
        bare = text.rstrip(SPACES)
        if not bare:
            fault = BLANK
        elif here == self.before or bytes(digest) in self.marks:
            fault = DUPLICATE
        else:
            fault = GOOD if bare[-1] in ".!?" else TRUNCATED
        self.counts[fault] += 1
        if self.before is not None and self.before[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = here
        self.repair.step(role, text, fault)

    def chunk(self) -> tuple | None:
        """A row of pointers, where there are enough."""
        pointers = self.repair.pointers
        if len(pointers) < 4 * self.size:
            return None
        self.repair.pointers = bytearray()
        self.chunks += 1
        return (self.conv, self.chunks - 1, False, bytes(pointers), None, *[None] * 8)

    def finish(self) -> tuple:
        cost, state, repaired = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        faults = [self.counts[f] for f in (BLANK, DUPLICATE, TRUNCATED)]
        pointers = bytes(self.repair.pointers)
        audit = None if self.chunks else trace(pointers, state)[0] + INSERT * MISSING[state]
        pointers = pointers if self.chunks else b""
        return (self.conv, self.chunks, True, pointers, state, gaps, *faults, self.illegal, cost, audit, repaired)


def same(a, b) -> bool:
    return a == b or (a is None and b is None)


def text_or_none(value) -> str | None:
    return value if isinstance(value, str) else None


def framed(rows: list[tuple], ddl: str) -> pd.DataFrame:
    """Rows as the columns of a DDL; whole numbers stay whole beside nulls."""
    columns = [c.split() for c in ddl.split(", ")]
    out = pd.DataFrame(rows, columns=[c for c, _ in columns])
    return out.astype({c: "Int64" for c, kind in columns if kind in ("long", "int")})


def streamed(rows: DataFrame, chunk: int) -> DataFrame:
    """Last rows of conversations, and rows of pointers of those with more than ``chunk`` turns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: Stream | None = None
        for batch in batches:
            done = []
            columns = [batch[c].tolist() for c in ("conv", "turn", "kind", "role", "text", "digest", "dropped")]
            for conv, *row in zip(*columns):
                conv = text_or_none(conv)
                if now is None or not same(now.conv, conv):
                    if now is not None:
                        done.append(now.finish())
                    now = Stream(conv, chunk)
                now.take(*row)
                if piece := now.chunk():
                    done.append(piece)
            if done:
                yield framed(done, STREAMED)
        if now is not None:
            yield framed([now.finish()], STREAMED)

    return rows.mapInPandas(run, STREAMED)


def traced(rows: DataFrame) -> DataFrame:
    """(conv, audit) of conversations whose pointers are in several rows, read from the last to the first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = START
        for batch in batches:
            done = []
            for conv, chunk, last, pointers, at in zip(*[batch[c].tolist() for c in ("conv", "chunk", "last", "pointers", "state")]):
                if last:
                    state = int(at)
                added = INSERT * MISSING[state] if last else ""
                letters, state = trace(bytes(pointers), state)
                done.append((text_or_none(conv), chunk, letters + added))
            yield framed(done, "conv string, chunk long, letters string")

    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc())
    pieces = ordered.mapInPandas(run, "conv string, chunk long, letters string")
    return pieces.groupBy("conv").agg(F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "letters")))["letters"], "").alias("audit"))


def repair_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False, chunk: int = CHUNK
) -> DataFrame:
    """One row for each conversation: its faults, and cost, edits and digest of its cheapest repair."""
    kind = conversations.schema[conv_id].dataType
    found = stage(streamed(in_order(turns(conversations, conv_id, turn, role, text, damage)), chunk), "repair-streamed")
    names = [c.split()[0] for c in STATS.split(", ")]
    short = found.filter("last and chunk = 0").select("conv", *names)
    long = found.filter("chunk > 0 or not last")
    # the chunks of a conversation include number 0, its last row has their number
    giant = found.filter("last and chunk > 0").select("conv").alias("g")
    parts = found.alias("f").join(giant, F.col("f.conv").eqNullSafe(F.col("g.conv")), "left_semi")
    audits = traced(parts).withColumnRenamed("conv", "_conv").withColumnRenamed("audit", "_audit")
    ends = long.filter("last").join(audits, F.col("conv").eqNullSafe(F.col("_conv"))).withColumn("audit", F.col("_audit"))
    return short.unionByName(ends.select("conv", *names)).select(F.col("conv").cast(kind).alias("conv_id"), *names)


def repaired_turns(
    conversations: DataFrame, repairs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False
) -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations, from the edits that ``repairs`` lists."""
    kind = conversations.schema[conv_id].dataType
    rows = turns(conversations, conv_id, turn, role, text, damage).filter(~F.col("dropped"))
    rows = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text")
    edits = repairs.select(F.col("conv_id").cast("string").alias("conv"), F.lit(0).alias("kind"), F.lit(NO_TURN).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    ordered = edits.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, state, place = "", 0, START, 0

        def inserted(conv) -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == INSERT:
                yield conv, place, NEXT_ROLE[state], ""
                at, state, place = at + 1, NEXT_STATE[state], place + 1

        for batch in batches:
            done = []
            for conv, is_row, role, text in zip(*[batch[c].tolist() for c in ("conv", "kind", "role", "text")]):
                conv = text_or_none(conv)
                if not is_row:
                    audit, at, state, place = text, 0, START, 0
                    done += inserted(conv)
                    continue
                letter, at = audit[at], at + 1
                if letter != LETTERS[DELETE]:
                    kept = letter == LETTERS[KEEP]
                    done.append((conv, place, role if kept else NEXT_ROLE[state], text))
                    state, place = KEPT[state, role[:1]] if kept else NEXT_STATE[state], place + 1
                done += inserted(conv)
            yield framed(done, "conv string, place long, role string, text string")

    found = ordered.mapInPandas(run, "conv string, place long, role string, text string")
    return found.select(F.col("conv").cast(kind).alias("conv_id"), "place", "role", "text")
