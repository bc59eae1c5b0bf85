"""Secrets: exact patterns, and further strings that a character network takes for secrets.

Base spans (assign, access, hex) are leftmost, non-overlapping matches of fixed patterns. Candidates are all
runs of MIN_RUN or more characters that keys are made of, and shorter strings of SHORT or more that follow a cue such as
``pwd:``. A small convolutional network in numpy reads each candidate with its surroundings, in windows that slide over the
whole of it and past its end: character classes, marked where they belong to the candidate, are embedded, convolved, pooled by
maximum and weighed. A candidate's probability is the highest of its windows.
It is trained on all labelled findings, candidates that a base span touches against the others. A hash deals them into halves. One trains
the weights: its findings are dealt into blocks, in every epoch each block's task goes on from the same weights over all of its findings, and
what the blocks come to is averaged. The other calibrates the output by Platt's method, whose sums run over all of its findings, and gives the
threshold, the highest one that still finds RECALL of its labelled secrets. What is above it and in no base span is added as kind
``network``. What base spans leave of a candidate is a candidate of its own if it has MIN_RUN characters, however long the whole is.
With fewer than MIN_LABELLED findings of either kind there is nothing to train on and nothing is added; ``trained`` says so on every row.

A span is a whole candidate of up to WINDOW characters; of a longer one, what the windows above the threshold see of it,
out to the next separator. A null or empty text has no spans. Every row gets its own result whatever its id. Positions are code points.
"""

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import per_text, slices, stage, wide_rows, with_result

# Patterns and order of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
CUES = ("passw", "secret", "token", "key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
ADDED = "network"

MIN_RUN = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
SHORT = 6
CUED = re.compile(
    r"""(?:pass|pwd|pin|secret|token|key|cred|auth|login)[a-z_-]{0,16}["']?[\x20\t]{0,4}(?:[:=]|is\x20)[\x20\t]{0,4}["']?([A-Za-z0-9+/_=.!@#$%^&*-]+)""",
    re.IGNORECASE | re.ASCII,
)
CUED_HEADS = ("pass", "pwd", "pin", "secret", "token", "key", "cred", "auth", "login")
BEFORE, WINDOW = 24, 64
#: Characters between windows, and past a candidate's end that the last one sees at least.
STRIDE, AFTER = 20, 4
PIECE = re.compile("[A-Za-z0-9_-]")
MIN_LABELLED = 30
#: Findings of a block; of the rarer kind each block has about FEWEST, copies included.
BLOCK, FEWEST = 8192, 512
#: Views that go through the network at once.
JUDGED = 256
RECALL = 0.98
EMBED, FILTERS, WIDTH, EPOCHS, BATCH, RATE = 8, 16, 5, 12, 64, 0.01
NEWTON_STEPS, SMALL_STEP, RIDGE, ROUNDING = 100, 1e-6, 1e-3, 1e-12
#: Character classes: each printable ASCII character is its own; then control, other, padding, and inside-candidate marks.
OTHER, CONTROL, PAD = 96, 97, 98
INSIDE = 99
CLASSES = 2 * INSIDE


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans by start, then by kind as listed."""
    found = []
    low = t.lower()
    if any(c in low for c in CUES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    if "AKIA" in t:
        found += [("access", *m.span()) for m in ACCESS.finditer(t) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(t)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def touches(spans: list[tuple[str, int, int]]):
    """A test whether a range touches any of some spans."""
    edges = sorted((s, e) for _, s, e in spans)
    starts = [s for s, _ in edges]
    ends = np.maximum.accumulate([e for _, e in edges]).tolist() if edges else []

    def test(start: int, end: int) -> bool:
        i = bisect_left(starts, end)
        return bool(i) and ends[i - 1] > start

    return test


def view(t: str, start: int, end: int, run: int | None = None) -> np.ndarray:
    """Classes of WINDOW characters from BEFORE ahead of a place; letter and digit values are kept.

    Characters up to ``end``, from ``run`` on or else from the place, are marked as the candidate's.
    """
    left = t[max(0, start - BEFORE) : start]
    seen = left + t[start : start + WINDOW - BEFORE]
    codes = np.array([ord(c) for c in seen], np.int64)
    codes = np.where(codes > 126, OTHER, np.where(codes < 32, CONTROL, codes - 32))
    out = np.full(WINDOW, PAD, np.int64)
    out[BEFORE - len(left) : BEFORE - len(left) + len(codes)] = codes
    first = start if run is None else run
    out[max(0, BEFORE - start + first) : max(0, min(WINDOW, BEFORE - start + end))] += INSIDE
    return out


def candidates(t: str) -> list[tuple[int, int]]:
    """Ranges of all runs and of shorter strings after a cue, by start."""
    found = [m.span() for m in RUN.finditer(t)]
    low = t.lower()
    if any(c in low for c in CUED_HEADS):
        taken = touches([("", s, e) for s, e in found])
        found += [m.span(1) for m in CUED.finditer(t) if m.end(1) - m.start(1) >= SHORT and not taken(*m.span(1))]
    return sorted(found)


def window_starts(start: int, end: int) -> range:
    """Where the windows of a candidate start; together they see all of it and what follows."""
    return range(start, max(start + 1, end + AFTER - (WINDOW - BEFORE) + STRIDE), STRIDE)


def window_span(t: str, start: int, end: int, at: int) -> tuple[int, int]:
    """What to mark for a window: the candidate, or of a long one the window's part, out to the next separators."""
    if end - start <= WINDOW:
        return start, end
    s, e = max(start, min(at, end - STRIDE)), min(end, at + WINDOW - BEFORE)
    while s > start and PIECE.match(t, s - 1):
        s -= 1
    while e < end and PIECE.match(t, e):
        e += 1
    return s, e


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


class Network:
    """Embedding, one convolution, maximum over places, one weight per filter; trained by Adam."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.p = {
            "embed": random.normal(0, 0.5, (CLASSES, EMBED)),
            "kernel": random.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
            "bias": np.zeros(FILTERS), "out": random.normal(0, 0.3, FILTERS), "shift": np.zeros(1),
        }
        self.slope, self.offset, self.threshold = 1.0, 0.0, 2.0

    def windows(self, x: np.ndarray) -> np.ndarray:
        e = self.p["embed"][x]
        return np.concatenate([e[:, k : WINDOW - WIDTH + 1 + k] for k in range(WIDTH)], axis=2)

    def raw(self, x: np.ndarray) -> np.ndarray:
        h = self.windows(x) @ self.p["kernel"] + self.p["bias"]
        return np.maximum(h.max(axis=1), 0) @ self.p["out"] + self.p["shift"][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x))

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -40, 40)))

    def start(self) -> np.ndarray:
        """Weights and Adam's two moments before the first epoch, end to end."""
        weights = np.concatenate([w.ravel() for w in self.p.values()])
        return np.concatenate([weights, np.zeros(2 * len(weights))])

    def put(self, state: np.ndarray) -> list[dict[str, np.ndarray]]:
        """Take over a state's weights; returns its moments by name."""
        sizes = [w.size for w in self.p.values()]
        parts = np.split(state.copy(), np.cumsum(sizes * 3)[:-1])
        named = [{k: v.reshape(w.shape) for (k, w), v in zip(self.p.items(), parts[at : at + len(sizes)])} for at in range(0, len(parts), len(sizes))]
        self.p = named[0]
        return named[1:]

    def epoch(self, state: np.ndarray, number: int, x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 11) -> np.ndarray:
        """The state after one epoch over some findings, whose order is that epoch's own."""
        m, v = self.put(state)
        random = np.random.default_rng(seed)
        for _ in range(number + 1):
            order = random.permutation(len(x))
        step = number * -(-len(x) // BATCH)
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            for k, g in self.gradient(x[rows], y[rows], weight[rows]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return np.concatenate([w.ravel() for part in (self.p, m, v) for w in part.values()])

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        seen = self.windows(x)
        h = seen @ self.p["kernel"] + self.p["bias"]
        place = h.argmax(axis=1)
        rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)[None]
        peak = h[rows, place, filters]
        active = np.maximum(peak, 0)
        wrong = (1 / (1 + np.exp(-np.clip(active @ self.p["out"] + self.p["shift"][0], -40, 40))) - y) * weight / len(x)
        back = wrong[:, None] * self.p["out"] * (peak > 0)
        chosen = seen[rows, place]
        to_seen = back[:, :, None] * self.p["kernel"].T[None]
        embed = np.zeros_like(self.p["embed"])
        for k in range(WIDTH):
            np.add.at(embed, x[rows, place + k], to_seen[:, :, k * EMBED : (k + 1) * EMBED])
        return {
            "embed": embed, "kernel": np.einsum("nfd,nf->df", chosen, back), "bias": back.sum(axis=0),
            "out": active.T @ wrong, "shift": wrong.sum(keepdims=True),
        }

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Platt scaling on held-out findings; the threshold is the highest that keeps the recall."""
        z = self.raw(x)
        self.scale(lambda a, b, hi, lo: newton_sums(z, np.where(y == 1, hi, lo), a, b), y.sum(), (1 - y).sum())
        scores = np.sort(self.probability(x[y == 1]))
        self.threshold = float(scores[int((1 - recall) * len(scores))])

    def scale(self, sums: Callable[[float, float, float, float], list[float]], secret: float, other: float) -> None:
        """Slope and offset by Newton's method, from sums over all findings; a step that overshoots is halved."""
        hi, lo = (secret + 1) / (secret + 2), 1 / (other + 2)

        def summed(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            loss, zr, r, wzz, wz, w = sums(*at.tolist(), hi, lo)
            return loss + RIDGE / 2 * (at @ at), np.array([zr, r]) - RIDGE * at, np.array([[wzz, wz], [wz, w]]) + RIDGE * np.eye(2)

        at = np.array([1.0, 0.0])
        loss, gradient, curve = summed(at)
        for _ in range(NEWTON_STEPS):
            step = np.linalg.solve(curve, gradient)
            new = summed(at + step)
            while new[0] > loss + ROUNDING * abs(loss) and np.abs(step).max() >= SMALL_STEP:
                step = step / 2
                new = summed(at + step)
            at, (loss, gradient, curve) = at + step, new
            if np.abs(step).max() < SMALL_STEP:
                break
        self.slope, self.offset = at.tolist()


def newton_sums(z: np.ndarray, target: np.ndarray, a: float, b: float) -> list[float]:
    """What a step of Platt's method sums up: the loss, residuals with and without the output, weights by its powers."""
    u = a * z + b
    p = 1 / (1 + np.exp(-np.clip(u, -40, 40)))
    w, r, loss = p * (1 - p) + 1e-9, target - p, np.maximum(u, 0) + np.log1p(np.exp(-np.abs(u))) - target * u
    return [float(t) for t in (loss.sum(), z @ r, r.sum(), w @ (z * z), w @ z, w.sum())]


def finding_views(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every window of the candidates as (rank, secret, view); rank is a hash of what the network sees, so copies share it."""

    def make():
        def work(t: str) -> tuple:
            hit, secret, views = touches(base_spans(t)), [], []
            for s, e in candidates(t):
                whole = hit(s, e)
                for at in window_starts(s, e):
                    here = hit(max(s, min(at, e - 1)), min(e, at + WINDOW - BEFORE)) if e - s > WINDOW else whole
                    if here == whole:  # beside a labelled part of a long run: neither kind
                        secret.append(whole)
                        views.append(view(t, at, e, s).astype(np.uint8).tobytes())
            return secret, views

        return work

    found = per_text("secret array<boolean>, view array<binary>", make)(F.col(text))
    each = docs.select(found.alias("f")).select(F.explode(F.arrays_zip("f.secret", "f.view")).alias("x")).select("x.*")
    return each.withColumn("rank", F.xxhash64("view"))


def stacked(views: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), np.uint8).reshape(-1, WINDOW)


def blocks_of(findings: DataFrame, secret: int, other: int) -> tuple[DataFrame, int, int]:
    """Findings in blocks, a row each, with the copies there are of a secret and of another finding.

    Where a kind is so rare that blocks would have fewer than FEWEST of it, each of its findings is in several blocks.
    """
    blocks = -(-(secret + other) // BLOCK)
    of_secret, of_other = (max(1, min(blocks, -(-FEWEST * blocks // max(1, n)))) for n in (secret, other))
    copies = F.when(F.col("secret"), of_secret).otherwise(of_other)
    first = F.pmod(F.xxhash64("rank"), F.lit(blocks))
    dealt = findings.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn("block", F.pmod(first + F.col("copy"), F.lit(blocks)))
    rows = F.array_sort(F.collect_list(F.struct((~F.col("secret")).alias("other"), "rank", "view"))).alias("rows")
    packed = dealt.groupBy("block").agg(rows).select(F.col("block").cast("int").alias("block"), "rows.other", "rows.view")
    return stage(packed.repartitionById(min(blocks, 4096), "block"), "secret-blocks"), of_secret, of_other


def fit(network: Network, findings: DataFrame, secret: int, other: int) -> None:
    """Train over all of some findings: epochs in every block from the same state, which is then the blocks' average."""
    packed, of_secret, of_other = blocks_of(findings, secret, other)
    all_secret, all_other = secret * of_secret, other * of_other
    weight_secret, weight_other = (0.5 / max(1, n) * (all_secret + all_other) for n in (all_secret, all_other))

    def epoch(state: np.ndarray, number: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, n, first = np.zeros_like(state), 0, 0
            for batch in batches:
                for block, others, views in zip(batch["block"], batch["other"], batch["view"]):
                    y = 1.0 - np.asarray(others, float)
                    weight = np.where(y == 1, weight_secret, weight_other)
                    total, n, first = total + Network().epoch(state, number, stacked(views), y, weight), n + 1, first if n else block
            if n:
                yield pd.DataFrame({"first": [first], "n": [n], "total": [total.tobytes()]})

        return run

    state = network.start()
    for number in range(EPOCHS):
        with wide_rows(findings.sparkSession):
            sums = packed.mapInPandas(epoch(state, number), "first int, n int, total binary").collect()  # a row for each task
        sums.sort(key=lambda r: r["first"])
        state = sum(np.frombuffer(r["total"]) for r in sums) / sum(r["n"] for r in sums)
    network.put(state)


def value_at(values: DataFrame, place: int) -> float:
    """The value of a column ``z`` that has so many others before it in order: sorted by Spark, found by the sizes of the sorted partitions."""
    ordered = stage(values.orderBy("z").withColumn("at", F.monotonically_increasing_id()), "secret-order")
    sizes = ordered.groupBy(F.shiftright("at", 33).alias("part")).count().collect()
    for part, size in sorted((r.part, r["count"]) for r in sizes):
        if place < size:
            return ordered.filter(F.col("at") == (part << 33) + place).first().z
        place -= size
    raise ValueError("there are fewer values")


def calibrate(network: Network, findings: DataFrame, secret: int, other: int, recall: float) -> None:
    """Platt scaling and threshold over all of some findings, whose sums and order are Spark's."""

    @F.pandas_udf("double")
    def raw(views: pd.Series) -> pd.Series:
        parts = [network.raw(stacked(views.iloc[at : at + JUDGED])) for at in range(0, len(views), JUDGED)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    scores = stage(findings.select("secret", raw("view").alias("z")), "secret-scores")

    def sums(a: float, b: float, hi: float, lo: float) -> list[float]:
        z, u, target = F.col("z"), a * F.col("z") + b, F.when(F.col("secret"), hi).otherwise(lo)
        p = 1 / (1 + F.exp(-F.least(F.greatest(u, F.lit(-40.0)), F.lit(40.0))))
        w, r, loss = p * (1 - p) + 1e-9, target - p, F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u))) - target * u
        return list(scores.agg(*[F.sum(x).alias(f"s{i}") for i, x in enumerate((loss, z * r, r, w * z * z, w * z, w))]).first())

    network.scale(sums, secret, other)
    place = int((1 - recall) * secret)
    z = value_at(scores.filter("secret").select((F.col("z") * float(np.sign(network.slope))).alias("z")), place) * np.sign(network.slope)
    network.threshold = float(network.calibrated(np.array([z]))[0])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> Network | None:
    """Network fitted to all findings of the corpus; equal views count once."""
    findings = stage(finding_views(docs, doc_id, text).distinct(), "secret-findings")
    findings = findings.withColumn("held", F.shiftright("rank", 8).bitwiseAND(F.lit(1)) == 1)
    numbers = {(r.held, r.secret): r["count"] for r in findings.groupBy("held", "secret").count().collect()}
    (learnt, learnt_other), (held, held_other) = ([numbers.get((h, kind), 0) for kind in (True, False)] for h in (False, True))
    if min(learnt + held, learnt_other + held_other) < MIN_LABELLED:
        return None
    network = Network()
    fit(network, findings.filter("not held"), learnt, learnt_other)
    calibrate(network, findings.filter("held"), held, held_other, recall)
    return network


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def outside(start: int, end: int, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The parts of a range that no base span covers; of a range that one touches, those of SHORT or more."""
    parts, at = [], start
    for _, s, e in sorted(base, key=lambda x: x[1]):
        if s < end and e > start:
            parts.append((at, s))
            at = max(at, e)
    if at == start and not parts:
        return [(start, end)]
    return [(s, e) for s, e in [*parts, (at, end)] if e - s >= SHORT]


def judged(start: int, end: int, base: list[tuple[str, int, int]], hit: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """What the network judges of a candidate: all of it, or the parts of MIN_RUN characters that base spans leave."""
    if not hit(start, end):
        return [(start, end)]
    return [(s, e) for s, e in outside(start, end, base) if e - s >= MIN_RUN]


def all_spans(texts: list[str], network: Network | None) -> list[tuple[list, list]]:
    """Base spans and all spans of each text; candidates of many texts go through the network at once."""
    base = [base_spans(t) for t in texts]
    extra: list[list] = [[] for _ in texts]
    if network is not None:
        owner, spans, views = [], [], []

        def judge() -> None:
            if views:
                sure = network.probability(np.stack(views)) >= network.threshold
                for o, span, yes in zip(owner, spans, sure):
                    if yes:
                        extra[o].append(span)
            owner.clear(), spans.clear(), views.clear()

        for i, t in enumerate(texts):
            hit = touches(base[i])
            for s, e in [part for c in candidates(t) for part in judged(*c, base[i], hit)]:
                for at in window_starts(s, e):
                    owner.append(i), spans.append((s, e, at)), views.append(view(t, at, e, s))
                    if len(views) >= JUDGED:
                        judge()
        judge()
    order = (*KINDS, ADDED)
    out = []
    for t, b, x in zip(texts, base, extra):
        added = [(ADDED, *part) for s, e in merged([window_span(t, *w) for w in x]) for part in outside(s, e, b)]
        out.append((b, sorted(b + added, key=lambda s: (s[1], order.index(s[0])))))
    return out


def secrets_found(text: Column, network: Network | None) -> Column:
    """Struct of counts, spans and whether a network was there to add any."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, trained boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            for part in slices(texts):
                rows = []
                for base, spans in all_spans([t or "" for t in texts.iloc[part]], network):
                    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                    rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), network is not None))
                yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "trained"])

    return run(text)


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with a struct column ``found``, or ``found_`` beside one of that name; the network is trained on these same documents."""
    return with_result(docs, "found", secrets_found(F.col(text), train(docs, doc_id, text)))


def redact(t: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """A text with its spans replaced; overlapping spans become one mark."""
    out, done = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= done:
            out += [t[done:s], mark]
        done = max(done, e)
    return "".join([*out, t[done:]]) if out else t


def redacted(text: Column, network: Network | None, mark: str = "[SECRET]") -> Column:
    """The text without its secrets; a null text stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for part in slices(texts):
                some = texts.iloc[part]
                found = all_spans([t or "" for t in some], network)
                yield pd.Series([None if t is None else redact(t, spans, mark) for t, (_, spans) in zip(some, found)], dtype=object)

    return run(text)
