"""Periodic runs of words, found online by dyadic square catching, and texts with the repeats collapsed.

Words are appended one after another. At every level a block of 2^k words that is complete has a catcher, which
watches for periods of 2^k up to 2^(k+1) - 1; a word that is appended lies in reach of one catcher of each level. If it
equals the last word of the catcher's block, the suffixes that end in the two places are compared: where the whole
block has come again, the comparison is carried to the left as far as it holds and from then on advanced by each word
appended. As long as it holds it reports a new square with every word, and these squares merge: when it ends, they are
one run. A run of three periods repeats a whole block, so none is missed. A word seen for the first time wakes
nothing, and of other words the levels below the distance to their last place are passed over. A comparison whose
period is a multiple of that of a run under way around both places would find the same run and is not opened.

A run is a stretch of consecutive words with smallest period q and at least max(MIN_WORDS, MIN_PERIODS * q) words that
no neighbouring word extends keeping the period. Collapsing drops words that any run contains after its first q words,
and joins the others by single spaces.

Null and empty texts have no words, no runs and an empty collapsed text. A text may be of any length and is read whole;
state is one number a word. Rows keep their place whatever their ids; equal rows have equal results. ``plant`` overwrites
words of a tenth of the texts with periodic ones, by a hash of the id, so that runs of all lengths are there to be found; a null id plants nothing.
"""

import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from accesslake.llm.texts import SPACED_WORD, slices

MIN_WORDS, MIN_PERIODS = 24, 3
FIRST_COMPARED = 16

Run = tuple[int, int, int]


class RunCatcher:
    """Runs (start, length, period) of the words appended so far."""

    def __init__(self) -> None:
        self.words: list = []
        self.last: dict = {}
        #: Comparisons under way: period, and where the words began to equal those a period later.
        self.live: dict[int, int] = {}
        self.ended: dict[tuple[int, int], int] = {}

    def extend(self, words: Iterable) -> None:
        """Append words."""
        t, last, live = self.words, self.last, self.live
        here = len(t)
        for word in words:
            t.append(word)
            if live:
                for period in [p for p in live if t[here - p] != word]:
                    self.end(period, live.pop(period), here)
            before = last.get(word)
            last[word] = here
            if before is not None:
                block = 1 << (here - before).bit_length() - 1
                while 2 * block <= here + 1:
                    end = (here + 1 - block & -block) - 1
                    if t[end] == word:
                        self.wake(block, end, here)
                    block *= 2
            here += 1

    def wake(self, block: int, end: int, here: int) -> None:
        """Compare the suffix of a block with that of the words so far; a whole block opens a comparison."""
        t, period, first = self.words, here - end, end - block + 1
        if period in self.live:
            return
        near = max(first, end - FIRST_COMPARED)
        if t[near:end] != t[near + period : here]:
            return
        for shorter, start in self.live.items():
            if start <= end and period % shorter == 0:
                return
        if t[first:near] != t[first + period : near + period]:
            return
        while first and t[first - 1] == t[first - 1 + period]:
            first -= 1
        self.live[period] = first

    def end(self, period: int, start: int, stop: int) -> None:
        """Keep a stretch that is long enough; of equal stretches the smallest period counts."""
        length = stop - start
        if length >= MIN_WORDS and length >= MIN_PERIODS * period:
            self.ended[start, length] = min(period, self.ended.get((start, length), period))

    def runs(self) -> list[Run]:
        """All runs by start, then period; those that still go on end with the words so far."""
        for period, start in self.live.items():
            self.end(period, start, len(self.words))
        return sorted([(start, length, period) for (start, length), period in self.ended.items()], key=lambda r: (r[0], r[2]))


def runs_of(words: list) -> list[Run]:
    catcher = RunCatcher()
    catcher.extend(words)
    return catcher.runs()


def planted(words: list[str], doc_id: str | None) -> list[str]:
    """The words, or for a tenth of the ids the words with a periodic tail."""
    seed = crc32(doc_id.encode()) if doc_id is not None else 1
    if seed % 10 or not words:
        return words
    n, part = len(words), seed // 10
    at = part % n
    period = 1 + (n - at) // (3 + part % 8)
    return words[:at] + [words[at + (i - at) % period] for i in range(at, n)]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods; of equal ones the first, then that of the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[str], runs: list[Run]) -> str:
    kept, at = [], 0
    for first, stop in sorted((start + period, start + length) for start, length, period in runs):
        if first > at:
            kept += words[at:first]
        at = max(at, stop)
    return " ".join(kept + words[at:])


FOUND = "starts array<long>, lengths array<long>, periods array<long>, start long, length long, period long, collapsed string"


def found_runs(text: Column, doc_id: Column, plant: bool = False) -> Column:
    """Struct of the runs by start and period, the strongest of them, and the collapsed text."""

    @pandas_udf(FOUND)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = re.compile(SPACED_WORD).findall

        def work(text: str | None, doc_id: str | None) -> tuple:
            words = find(text or "")
            if plant:
                words = planted(words, doc_id)
            runs = runs_of(words)
            best = strongest(runs) or (None, None, None)
            return (*map(list, zip(*runs)), *best, collapsed(words, runs)) if runs else ([], [], [], *best, " ".join(words))

        names = [part.split()[0] for part in FOUND.split(", ")]
        for texts, ids in batches:
            for part in slices(texts):
                rows = [work(t, i) for t, i in zip(texts.iloc[part], ids.iloc[part])]
                out = pd.DataFrame(rows, columns=names)
                yield out.astype({c: "Int64" for c in ("start", "length", "period")})

    return run(text, doc_id.cast("string"))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """(doc_id, runs, strongest, collapsed): one row for each document; runs are structs of start, length, period."""
    found = found_runs(F.col(text), F.col(doc_id), plant)
    rows = docs.select(F.col(doc_id).alias("doc_id"), found.alias("f"))
    fields = ("start", "length", "period")
    runs = F.transform(
        F.arrays_zip("f.starts", "f.lengths", "f.periods"),
        lambda x: F.struct(*[x[f"{c}s"].alias(c) for c in fields]),
    )
    best = F.when(F.col("f.start").isNotNull(), F.struct(*[F.col(f"f.{c}") for c in fields]))
    return rows.select("doc_id", runs.alias("runs"), best.alias("strongest"), F.col("f.collapsed").alias("collapsed"))
