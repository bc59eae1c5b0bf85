"""Personal data: exact patterns, and further spans found by weak supervision.

Base spans (email, ip, card, phone) are leftmost, non-overlapping matches of fixed patterns. Further kinds
(person, national_phone, ssn, iban, obfuscated_email) start as loose candidates. Regex, gazetteer and
context labelers vote on every candidate of every document: yes, no or nothing. Counts of equal vote and
feature patterns, whose number is bounded by the labelers, are summed over the corpus;
expectation-maximisation estimates the labelers' reliabilities from them and trains a logistic span
classifier on its posteriors. A candidate is added if the classifier is at least THRESHOLD sure and the span
touches no base span.

A null or empty text has no spans. Where the corpus has no candidates, nothing is trained and nothing
added. Every row gets its own result, repeated ids and null ids included. Positions are code points.
"""

import hashlib
import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import per_text, with_result

# Patterns of the contract, with possessive forms where the text cannot match otherwise.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9].)[0-9]*+(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ("email", "ip", "card", "phone")

# Kinds the method adds, and loose patterns of their candidates.
ADDED = {
    "person": re.compile(r"[MDP](?<!\w.)(?:(?<=M)rs?|(?<=M)s|(?<=D)r|(?<=P)rof)\.? [A-ZÀ-Þ][a-zß-ÿ]{1,20}(?: [A-ZÀ-Þ][a-zß-ÿ]{1,20})?"),
    "national_phone": re.compile(
        r"[(0-9](?<![\w+.-].)(?:(?<=\()[0-9]{3}|(?<=[0-9])[0-9]{2})\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"
    ),
    "ssn": re.compile(r"[0-9](?<![\w-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"[A-Z](?<!\w.)[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "obfuscated_email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]{1,63})+"),
}
ALL_KINDS = (*BASE_KINDS, *ADDED)

#: Every candidate of a kind has one of these in its text.
NEEDS = {"person": ("Mr", "Ms", "Dr", "Prof"), "obfuscated_email": ("(at", "[at")}

# Gazetteers and context words.
GIVEN_NAMES = frozenset(
    "Anna Ben Carlos Clara David Elena Emma Frank George Hans Helen Ines Jack James Jane John Juan Karl Laura "
    "Lucas Luis Maria Marie Mark Mary Michael Nina Oliver Paul Peter Robert Sarah Sofia Thomas Victor".split()
)
COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SI SK".split())
TOP_DOMAINS = frozenset("com org net edu gov de fr es it uk eu io info".split())
CUES = {
    "person": re.compile(r"(?i)\b(?:name|contact|dear|signed|by|herr|frau|monsieur|madame|se[nñ]or)\b"),
    "national_phone": re.compile(r"(?i)\b(?:phone|tel|call|fax|mobile|cell|telefon|t[eé]l)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social|security)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    "obfuscated_email": re.compile(r"(?i)\b(?:mail|e-?mail|contact|write|reach)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:version|isbn|issn|part|serial|example|figure|table|page|order)\b")
CUE_CHARS = 48
LABELERS = ("regex", "gazetteer", "context", "against", "neighbours")
ROUNDS, PRIOR, THRESHOLD = 50, 0.5, 0.9


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def emails(t: str):
    """One look at each @: the run before it, not reaching into the last match, and the domain after it."""
    done, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > done and t[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(t, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = t.find("@", max(done, at + 1))


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed, then by start."""
    found = [("email", s, e) for s, e in emails(t)]
    for m in IP.finditer(t):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(t):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in t:
        for m in PHONE.finditer(t):
            if 9 <= sum(map(m.group().count, "0123456789")) <= 15:
                found.append(("phone", *m.span()))
    return found


def candidates(t: str):
    """Loose matches of the added kinds with their votes (1, 0 or -1 for nothing)."""
    for kind, pattern in ADDED.items():
        if kind in NEEDS and not any(x in t for x in NEEDS[kind]):
            continue
        for m in pattern.finditer(t):
            yield kind, m.start(), m.end(), votes(kind, m.group(), t, m.start(), m.end())


def strict(kind: str, x: str) -> int:
    """The regex labeler: a stricter look at the form."""
    if kind == "person":
        return 1 if x.count(" ") == 2 else -1
    if kind == "ssn":
        return 0 if x[:3] in ("000", "666") or x[0] == "9" or x[4:6] == "00" or x[-4:] == "0000" else 1
    if kind == "iban":
        plain = x.replace(" ", "")
        return int(int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1)
    if kind == "national_phone":
        digits = re.sub("[^0-9]", "", x)
        return int(digits[0] > "1" and digits[3] > "1")
    return 1 if "." not in x else -1


def gazetteer(kind: str, x: str) -> int:
    if kind == "person":
        return 1 if GIVEN_NAMES & set(x.split()) else -1
    if kind == "iban":
        return int(x[:2] in COUNTRIES)
    if kind == "obfuscated_email":
        return int(re.split(r"[ )\]]+", x)[-1].lower() in TOP_DOMAINS)
    return -1


def votes(kind: str, x: str, t: str, start: int, end: int) -> tuple[int, ...]:
    before = t[max(0, start - CUE_CHARS) : start]
    around = t[max(0, start - 12) : start] + t[end : end + 12]
    crowded = sum(c.isdigit() for c in around) > 6
    return (
        strict(kind, x), gazetteer(kind, x), 1 if CUES[kind].search(before) else -1,
        0 if AGAINST.search(before) else -1, 0 if crowded else -1,
    )


def pattern_key(kind: str, v: tuple[int, ...]) -> str:
    return kind + ":" + "".join("01-"[x] for x in v)


def estimate(patterns: dict[str, int]) -> tuple[dict[str, float], np.ndarray]:
    """Posteriors per pattern and reliabilities, by EM over counts of vote patterns.

    Labelers vote independently given the truth; Laplace counts keep them inside 0..1 and a labeler
    starts as right four times of five.
    """
    keys = sorted(patterns)
    votes_of = np.array([["01-".index(c) for c in k.rpartition(":")[2]] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    told = votes_of < 2
    right = np.full((2, len(LABELERS)), 0.8)
    share = PRIOR
    for _ in range(ROUNDS):
        log = np.zeros((len(keys), 2))
        for truth in (0, 1):
            agree = votes_of == truth
            each = np.where(agree, np.log(right[truth]), np.log(1 - right[truth]))
            log[:, truth] = (each * told).sum(axis=1) + np.log(share if truth else 1 - share)
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        share = (n @ post + 1) / (n.sum() + 2)
        for truth, w in ((0, n * (1 - post)), (1, n * post)):
            agree = (votes_of == truth) & told
            right[truth] = (w @ agree + 4) / (w @ told + 5)
    return dict(zip(keys, post)), right


def features(key: str) -> np.ndarray:
    """One-hot kind and one-hot vote of each labeler."""
    kind, _, v = key.rpartition(":")
    x = np.zeros(len(ADDED) + 3 * len(LABELERS) + 1)
    x[list(ADDED).index(kind)] = x[-1] = 1
    for i, c in enumerate(v):
        x[len(ADDED) + 3 * i + "01-".index(c)] = 1
    return x


def train(patterns: dict[str, int]) -> dict[str, float]:
    """Probability of each pattern by a logistic classifier fitted to the posteriors, weighted by counts."""
    if not patterns:
        return {}
    post, _ = estimate(patterns)
    keys = sorted(patterns)
    x, y = np.stack([features(k) for k in keys]), np.array([post[k] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - 0.1 * w
        bend = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(bend, slope)
    return dict(zip(keys, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))


def vote_patterns(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How often each vote pattern occurs in the corpus: len(ADDED) * 3 ** len(LABELERS) rows at most."""

    def make():
        return lambda t: ([pattern_key(k, v) for k, _, _, v in candidates(t)],)

    found = docs.select(F.explode(per_text("keys array<string>", make)(F.col(text)).getField("keys")).alias("key"))
    return {r.key: r["count"] for r in found.groupBy("key").count().collect()}


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def personal_data(text: Column, sure: dict[str, float], threshold: float = THRESHOLD) -> Column:
    """Struct of counts and spans; ``sure`` is what ``train`` returned."""
    taken = frozenset(k for k, p in sure.items() if p >= threshold)

    def make():
        def work(t: str) -> tuple:
            base = base_spans(t)
            counts = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
            spans = list(base)
            if taken:
                edges = sorted((s, e) for _, s, e in base)
                starts = [s for s, _ in edges]
                ends = np.maximum.accumulate([e for _, e in edges]).tolist() if edges else []
                last: dict[str, int] = {}
                for kind, s, e, v in candidates(t):
                    i = bisect_left(starts, e)
                    if pattern_key(kind, v) in taken and not (i and ends[i - 1] > s) and s >= last.get(kind, 0):
                        spans.append((kind, s, e))
                        last[kind] = e
            return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans))

        return work

    schema = ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return per_text(schema, make)(text)


def find_personal_data(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with a struct column ``found``, or ``found_`` beside one of that name; labelers are weighed on these same documents."""
    return with_result(docs, "found", personal_data(F.col(text), train(vote_patterns(docs, text)), threshold))
