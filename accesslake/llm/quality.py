"""Quality rules whose cutoffs are chosen with a guarantee.

Each rule rejects a document whose metric exceeds a cutoff. Labelled documents, copies of a text counted once, are split in two by a hash
of their text. One half orders, per stratum, the lowerings of cutoffs worth having, the most bad documents for
each good one first: a nested sequence of rule sets. The other half tests the sequence from its mildest set on with the
exact binomial tail, counting good documents that any rule of the set rejects: a set is accepted if so few would
be seen with probability ``delta / strata`` were the true share ``alpha``. So all accepted sets hold together with probability
1 - delta, and no stratum loses more than ``alpha`` of its good documents to all rules. Only documents that pass the base rule are counted. Testing in a fixed order
needs no correction for rules or steps. With four strata a stratum needs 217 good labels in the tested half, about 434
in all, before a set that rejects none of them can be accepted.

Documents with fewer than MIN_WORDS words or too many words in repeated windows fail outright. A stratum with
too few labels, or none, gets no cutoff, and its documents are kept. A null stratum is one of its own. Null
and empty texts have no words and fail. Labels that are null, and labels of unknown documents, are left
out; a text labelled more than once counts once in a stratum, as good only if all its labels say so. Every row gets its own
verdict, whatever its id.
"""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import SPACED_WORD, per_text, stage

MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 20, 8, 30
SYMBOLS = "[#*$%&|<>]"
SPACES = " \t\n\x0b\x0c\r"
ALPHA, DELTA = 0.02, 0.05
#: Metrics in 0..1, larger is worse, by rule.
RULES = ("symbols", "duplicate_lines", "repeated_words", "upper_case", "marks", "one_word", "short_words", "long_words")
STEPS = 40
METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + ", ".join(f"{r} double" for r in RULES)
)


def repeated_words(words: list[str]) -> int:
    """Words inside a window of WINDOW words that the text has more than once.

    Windows are first told apart by a 64-bit hash; where hashes repeat the words themselves decide.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
            mixed ^= mixed >> np.uint64(29)
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    places = np.flatnonzero(np.isin(mixed, twice)).tolist()
    windows = [tuple(words[p : p + WINDOW]) for p in places]
    times = Counter(windows)
    inside = np.zeros(len(words) + 1, np.int64)
    for p, w in zip(places, windows):
        if times[w] > 1:
            inside[p] += 1
            inside[p + WINDOW] -= 1
    return int((np.cumsum(inside[:-1]) > 0).sum())


def text_metrics():
    find, blank = re.compile(SPACED_WORD).findall, re.compile(f"[^{SPACES}]").search
    upper, marks = re.compile("[A-ZÀ-ÖØ-Þ]"), re.compile("[!?=~^_@{}\\\\/+]")

    def work(t: str) -> tuple:
        words = find(t)
        n = len(words)
        chars = sum(map(len, words))
        n_symbols = sum([t.count(c) for c in "#*$%&|<>"])
        lines = [x for x in t.split("\n") if blank(x)]
        duplicates = len(lines) - len(set(lines))
        repeated = repeated_words(words)
        if not n:
            return (0, 0, n_symbols, duplicates, 0) + (0.0,) * len(RULES)
        most = Counter(words).most_common(1)[0][1] if n > 4 else 0
        mean = chars / n
        rules = (
            n_symbols / chars, duplicates / len(lines), repeated / n, len(upper.findall(t)) / chars, len(marks.findall(t)) / chars,
            most / n, max(0.0, 1 - mean / 4), max(0.0, 1 - 10 / mean),
        )
        return (n, chars, n_symbols, duplicates, repeated, *(min(1.0, r) for r in rules))

    return work


def quality_metrics(text: Column) -> Column:
    """Struct of the base counts and one metric for each rule."""
    return per_text(METRICS, text_metrics)(text)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n trials of probability p, exactly."""
    if n == 0:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def choose_cutoff(tune_good, tune_bad, test_good, level: float, risk: float) -> float | None:
    """Place, as a share, in a sequence of nested rejections, the last place the mildest, from documents per place.

    The strictest place that passes is taken only as far as it gains: it has to reject bad documents
    of the first half, at least twenty for each good one.
    """
    beyond = lambda counts: np.cumsum(np.asarray(counts)[::-1])[::-1]
    good, bad, tested, n = beyond(tune_good), beyond(tune_bad), beyond(test_good), int(np.sum(test_good))
    best, gain = None, 0
    for step in range(len(good) - 1, 0, -1):
        if binomial_tail(int(tested[step]), n, risk) > level:
            break
        worth = int(bad[step]) - 20 * int(good[step])
        if worth > gain:
            best, gain = step / len(good), worth
    return best


def rejection_order(good: np.ndarray, bad: np.ndarray) -> list[tuple[int, int]]:
    """(rule, step) by which cutoffs are lowered in turn, from counts of documents per rule and step."""
    good, bad = [np.cumsum(x[:, ::-1], axis=1)[:, ::-1] for x in (good, bad)]
    at, order = [STEPS] * len(RULES), []
    now = lambda counts, rule: counts[rule][at[rule]] if at[rule] < STEPS else 0
    while True:
        best = None
        for rule in range(len(RULES)):
            for step in range(at[rule] - 1, 0, -1):
                more_bad, more_good = int(bad[rule][step] - now(bad, rule)), int(good[rule][step] - now(good, rule))
                if more_bad > 20 * more_good:
                    best = max(best or (0, 0, 0, 0), (more_bad / (more_good + 0.5), more_bad, -rule, step))
        if best is None:
            return order
        at[-best[2]] = best[3]
        order.append((-best[2], best[3]))


def fit_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoffs) from rows of stratum, good, half and metrics; one row per stratum with labels in the first half.

    Only counts per stratum, label and half are gathered: by rule and step, and by place in the stratum's sequence.
    """
    step = lambda r: F.least(F.floor(F.col(r) * STEPS), F.lit(STEPS - 1)).cast("int")
    stepped = stage(labelled.select("stratum", "good", "half", F.array(*[step(r) for r in RULES]).alias("steps")), "quality-labelled")
    strata = max(1, stepped.select("stratum").distinct().count())
    counts = stepped.filter("not half").select("stratum", "good", F.posexplode("steps").alias("rule", "step"))

    def arrange(rows: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((2, len(RULES), STEPS), np.int64)
        for r in rows.itertuples(index=False):
            table[int(r.good), r.rule, r.step] += r.count
        order = rejection_order(table[1], table[0])
        place = np.zeros((len(RULES), STEPS), np.int64)  # 0: never rejected
        for i, (rule, at) in enumerate(order):
            place[rule, at:] = np.maximum(place[rule, at:], len(order) - i)
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "rules": [[r for r, _ in order]], "cuts": [[c for _, c in order]], "places": [place.tolist()]})

    counted = counts.groupBy("stratum", "good", "rule", "step").count()
    orders = counted.groupBy("stratum").applyInPandas(arrange, "stratum string, rules array<int>, cuts array<int>, places array<array<int>>")
    orders = stage(orders.withColumnRenamed("stratum", "_stratum"), "quality-orders")
    place = F.greatest(*[F.col("places")[i][F.col("steps")[i]] for i in range(len(RULES))]).alias("place")
    placed = stepped.join(orders, F.col("stratum").eqNullSafe(F.col("_stratum"))).select("stratum", "rules", "cuts", "good", "half", place)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rules, cuts = list(rows["rules"].iloc[0]), list(rows["cuts"].iloc[0])
        table = np.zeros((2, 2, len(rules) + 1), np.int64)
        for r in rows.itertuples(index=False):
            table[int(r.good), int(r.half), r.place] += r.count
        chosen = choose_cutoff(table[1, 0], table[0, 0], table[1, 1], delta / strata, alpha)
        taken = 0 if chosen is None else len(rules) + 1 - round(chosen * (len(rules) + 1))
        found = [2.0] * len(RULES)
        for rule, at in zip(rules[:taken], cuts[:taken]):
            found[rule] = at / STEPS
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "cutoffs": [found]})

    rows = stage(placed.groupBy("stratum", "rules", "cuts", "good", "half", "place").count(), "quality-counts")
    return rows.groupBy("stratum").applyInPandas(run, "stratum string, cutoffs array<double>")


def label_metrics(metrics: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Metrics of labelled texts with their label and half; k1 and k2 tell texts apart.

    Copies of a text in a stratum count once, as good only if all are labelled so: the bound is one of independent
    documents, and a text must not be on both sides.
    """
    own = labels.filter(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
    own = own.groupBy(F.col(doc_id).alias("doc_id")).agg((F.min(quality) > 0).alias("good"))
    half = (F.pmod(F.col("k1"), F.lit(2)) == 1).alias("half")
    texts = metrics.join(own, "doc_id").groupBy("stratum", "k1", "k2").agg(F.min("good").alias("good"), *[F.first(r).alias(r) for r in RULES])
    return texts.select("stratum", "good", half, *RULES)


def base_failed(m: str = "metrics") -> Column:
    n = F.col(f"{m}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED_PERCENT * n)


def with_verdict(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Adds base_failed and kept to rows with a ``metrics`` struct."""
    fitted = cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs"))
    joined = measured.join(fitted, F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left")
    beyond = [F.coalesce(F.col(f"metrics.{r}") >= F.col("_cutoffs")[i], F.lit(False)) for i, r in enumerate(RULES)]
    rejected = beyond[0]
    for b in beyond[1:]:
        rejected = rejected | b
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~rejected).drop("_stratum", "_cutoffs")


def fitted_metrics(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """Metrics of all documents as a stored table, and the cutoffs its labelled rows give."""
    measured = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), quality_metrics(F.col(text)).alias("metrics"),
        F.xxhash64(F.lit(1), F.col(text)).alias("k1"), F.xxhash64(F.lit(2), F.col(text)).alias("k2"),
    )
    measured = stage(measured, "quality-metrics")
    flat = measured.filter(~base_failed()).select("doc_id", "stratum", "k1", "k2", "metrics.*")
    return measured, stage(fit_cutoffs(label_metrics(flat, labels, doc_id)), "quality-cutoffs")


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> DataFrame:
    """One row per document with its counts, metrics and verdict."""
    measured, cutoffs = fitted_metrics(docs, labels, doc_id, text, stratum)
    judged = with_verdict(measured, cutoffs, "stratum")
    return judged.select("doc_id", "stratum", "metrics.*", "base_failed", "kept")


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> DataFrame:
    """Documents with a kept verdict, unchanged.

    The metrics are computed again beside each row, which costs less than shuffling the texts and
    judges repeated ids row by row.
    """
    _, cutoffs = fitted_metrics(docs, labels, doc_id, text, stratum)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = docs.select(row, F.col(stratum).cast("string").alias("stratum"), quality_metrics(F.col(text)).alias("metrics"))
    return with_verdict(measured, cutoffs, "stratum").filter("kept").select("row.*")
