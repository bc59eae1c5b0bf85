"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Labelled documents that are not held out are dealt into three parts by a hash of their id. In the first, at most LEXICON_SAMPLE
documents of either label, words and word beginnings are counted by label; those that occur in toxic documents beyond chance are a
learnt lexicon, with a weight, beside a short fixed one. The second, at most TREE_SAMPLE documents of either label, trains the
trees, so that they see the lexicon err as it will elsewhere. Samples are the smallest hashes of ids. Then every document's features are
summed to a margin, and all documents of the third part are counted by label and margin and pooled by adjacent violators to a
monotone map from margins to probabilities. The lexicon, at most MAX_TERMS terms, the sample's features and the counts, at most
MARGINS rows, are all that reaches the driver; no text but those of the samples is moved.

Features are densities and weights of lexicon words, how near to them a second-person pronoun stands, capitals,
punctuation and obfuscation (digits or signs among letters, letters set apart or repeated; such words are looked up
as the words they stand for). Label, language, source and id are no features.

Null and empty texts have all features zero and get the score of such a text. Texts are read whole. Null labels and labels of unknown documents
are left out; a document with several labels is toxic if any says so. Ids may repeat: each row is scored by its own text. A null id is
hashed as an empty one. Where a part lacks either label, what it gives is left out: no lexicon learnt, no trees, or no
calibration; without trees every score is the share of toxic labels among those not held out, 0 without any.
"""

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from accesslake.llm.texts import per_text, slices, stage
from accesslake.operators.joins import broadcast_if_small

#: Words taken for insults in any language, and second-person pronouns, whatever the labels say.
INSULTS = frozenset(
    "idiot idiota idioten imbecile imbécil moron stupid stupide estúpido dumb dumm blöd fool loser scum trash garbage pathetic worthless "
    "disgusting clown jerk bastard bitch asshole arschloch connard salaud ordure abruti cabrón pendejo gilipollas basura escoria "
    "versager abschaum nazi pig schwein cochon cerdo hate kill".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch vous votre toi ton tu te ti tus usted ustedes vos".split())

HELD_OUT, FOLDS = 5, 10
#: Folds up to these learn the lexicon and the trees; the rest calibrate.
LEXICON_FOLDS, TREE_FOLDS = 5, 8
BEGINNINGS = (4, 5, 6)
MIN_SEEN, MAX_TERMS, CHANCE = 4, 20_000, 1e-4
#: Documents of either label that the lexicon and the trees learn from, by smallest hash.
LEXICON_SAMPLE, TREE_SAMPLE = 20_000, 10_000
LEXICON, TREES, CALIBRATION = range(3)
ROUNDS, DEPTH, BINS, RATE, SHRINK, LEAST = 80, 4, 64, 0.15, 1.0, 5
MARGINS, MARGIN_RANGE = 4096, 16.0
KNOWN_WORDS = 100_000
FEATURES = (
    "learnt_share", "learnt_count", "learnt_most", "learnt_mean", "insult_share", "insult_count", "obfuscated_share", "obfuscated_hits",
    "nearness", "second_person", "capitals", "shouted", "exclaimed", "asked", "marks", "digits", "drawn_out", "n_words", "distinct",
)
STANDS_FOR = str.maketrans("013457@$!|€", "oieastasiie")
EDGES = ".,;:?\"'()[]{}<>«»„“”‘’¡¿…-–—*_~/\\"
UPPER = re.compile("[A-ZÀ-ÖØ-Þ]").findall
UNKNOWN = ()
DRAWN = re.compile(r"(.)\1{2,}")


def plain_word(token: str) -> tuple[str, bool]:
    """A token as the word it stands for, and whether it took more than case and edges to read it."""
    bare = token.strip(EDGES + "!").lower()
    if bare.isalpha():
        short = DRAWN.sub(r"\1", bare)
        return short, short != bare
    if not any(map(str.isalpha, bare)):
        return "", False
    letters = "".join([c for c in token.strip(EDGES).lower().translate(STANDS_FOR) if c.isalpha()])
    return DRAWN.sub(r"\1", letters), True


def terms_of(word: str) -> list[str]:
    """What the lexicon may list a word under."""
    return [word, *[f"{word[:k]}*" for k in BEGINNINGS if len(word) > k]] if len(word) > 2 else []


def tokens_of(text: str) -> list[str]:
    """Tokens between spaces; three or more single letters in a row are one token."""
    tokens = text.split()
    if sum([len(t) == 1 for t in tokens]) < 3:
        return tokens
    out, apart = [], []
    for t in [*tokens, ""]:
        if len(t) == 1 and t.isalpha():
            apart.append(t)
            continue
        out += [".".join(apart)] if len(apart) > 2 else apart
        apart = []
        out.append(t)
    return out[:-1]


def text_terms() -> Callable[[str], tuple]:
    known: dict[str, list[str]] = {}

    def work(text: str) -> tuple:
        found: set[str] = set()
        for token in set(tokens_of(text)):
            terms = known.get(token)
            if terms is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                terms = known[token] = terms_of(plain_word(token)[0])
            found.update(terms)
        return (list(found),)

    return work


def learnt_weights(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Weights of terms that toxic documents hold beyond chance: a lower bound of the log-odds ratio.

    ``counts`` has term, n_toxic, n_clean. A term with no more than MIN_SEEN toxic documents, or as many by chance with
    probability CHANCE, is no member; the strongest MAX_TERMS are kept.
    """
    a, b = F.col("n_toxic") + 0.5, F.col("n_clean") + 0.5
    ratio = F.log(a / (toxic + 1)) - F.log(b / (clean + 1))
    bound = ratio - 2 * F.sqrt(1 / a + 1 / b)
    share = (F.col("n_toxic") + F.col("n_clean")) * (toxic / (toxic + clean))
    # of n documents at the base rate, n_toxic or more have probability at most exp(-n * divergence), by Chernoff
    surprise = F.col("n_toxic") * F.log(F.col("n_toxic") / share) - F.col("n_toxic") + share
    wanted = counts.filter((F.col("n_toxic") >= MIN_SEEN) & (F.col("n_toxic") > share)).withColumns({"weight": bound, "surprise": surprise})
    rows = wanted.filter((F.col("surprise") > -math.log(CHANCE)) & (F.col("weight") > 0.5))
    return {r.term: float(r.weight) for r in rows.orderBy(F.col("weight").desc(), "term").limit(MAX_TERMS).select("term", "weight").collect()}


def text_features(lexicon: dict[str, float]) -> Callable[[str], list[float]]:
    """A function from a text to its features."""
    known: dict[str, tuple | None] = {}

    def look_up(token: str) -> tuple | None:
        """What a token adds to the features, or None if nothing."""
        word, read = plain_word(token)
        weight = max([lexicon.get(t, 0.0) for t in terms_of(word)], default=0.0)
        insult = word in INSULTS
        marks = (insult, read, word in SECOND_PERSON, len(token) > 2 and token.isupper(), bool(DRAWN.search(token)))
        if len(known) >= KNOWN_WORDS:
            known.clear()
        info = known[token] = (weight, *marks, bool(weight or insult)) if weight or any(marks) else None
        return info

    def work(text: str) -> list[float]:
        tokens = tokens_of(text)
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        counts = Counter(tokens)
        learnt = insults = obfuscated = hidden = second = shouted = drawn = 0
        most = total = 0.0
        hits, people = set(), set()
        for token, times in counts.items():
            info = known.get(token, UNKNOWN)
            if info is UNKNOWN:
                info = look_up(token)
            if info is None:
                continue
            weight, insult, read, person, loud, long, hit = info
            if weight:
                learnt += times
                total += weight * times
                most = max(most, weight)
            if insult:
                insults += times
            if read:
                obfuscated += times
                if hit:
                    hidden += times
            if person:
                second += times
                people.add(token)
            if hit:
                hits.add(token)
            shouted += times * loud
            drawn += times * long
        nearness = 0.0
        if hits and people:
            last_hit = last_person = None
            for i, token in enumerate(tokens):
                if token in hits:
                    last_hit = i
                if token in people:
                    last_person = i
                if last_hit is not None and last_person is not None:
                    nearness = max(nearness, 1 / (1 + abs(last_hit - last_person)))
                    last_hit, last_person = (last_hit, None) if last_hit > last_person else (None, last_person)
        size = len(text)
        upper = len(UPPER(text))
        signs = sum([text.count(c) for c in ".,;:\"'()-*_#"])
        digits = sum([text.count(c) for c in "0123456789"])
        return [
            learnt / n, math.log1p(learnt), most, total / n, insults / n, math.log1p(insults), obfuscated / n, math.log1p(hidden),
            nearness, second / n, upper / size, shouted / n, text.count("!") / size, text.count("?") / size, signs / size, digits / size,
            drawn / n, math.log1p(n), len(counts) / n,
        ]

    return work


class Trees:
    """Gradient boosting of the logistic loss over binned features; trees are complete, of DEPTH levels."""

    def __init__(self) -> None:
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        bins = self.binned(x)
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            tree = self.grow(bins, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += RATE * self.leaves(tree, bins)
        return self

    def grow(self, bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, highest bin to the left, leaf values); feature -1 sends all rows left."""
        width, inner = BINS + 1, 2**DEPTH - 1
        features, cuts = np.full(inner, -1), np.zeros(inner, np.int64)
        node = np.zeros(len(bins), np.int64)
        for level in range(DEPTH):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            for f in range(bins.shape[1]):
                at = (node - first) * width + bins[:, f]
                g, h, c = [np.bincount(at, w, n * width).reshape(n, width) for w in (gradient, hessian, None)]
                gl, hl, cl = [np.cumsum(v, axis=1)[:, :-1] for v in (g, h, c)]
                gt, ht, ct = [v.sum(axis=1)[:, None] for v in (g, h, c)]
                gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
                gain[(cl < LEAST) | (ct - cl < LEAST)] = 0
                place = gain.argmax(axis=1)
                value = gain[np.arange(n), place]
                for k in np.flatnonzero(value > best):
                    best[k], features[first + k], cuts[first + k] = value[k], f, place[k]
            node = self.below(features, cuts, node, bins)
        leaf = node - inner
        g, h = [np.bincount(leaf, w, 2**DEPTH) for w in (gradient, hessian)]
        return features, cuts, -g / (h + SHRINK)

    @staticmethod
    def below(features: np.ndarray, cuts: np.ndarray, node: np.ndarray, bins: np.ndarray) -> np.ndarray:
        f = features[node]
        right = (f >= 0) & (bins[np.arange(len(bins)), np.maximum(f, 0)] > cuts[node])
        return 2 * node + 1 + right

    def leaves(self, tree: tuple, bins: np.ndarray) -> np.ndarray:
        features, cuts, values = tree
        node = np.zeros(len(bins), np.int64)
        for _ in range(DEPTH):
            node = self.below(features, cuts, node, bins)
        return values[node - (2**DEPTH - 1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        return self.base + RATE * sum([self.leaves(t, bins) for t in self.trees], np.zeros(len(x)))


def pooled(places: np.ndarray, good: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and shares of a step function that never falls, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for place, hit, count in zip(places, good, all_):
        blocks.append([place * count, hit, count])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


class Model:
    """Lexicon, trees and calibration; what is missing is passed over."""

    def __init__(self, share: float) -> None:
        self.share = share
        self.lexicon: dict[str, float] = {}
        self.trees: Trees | None = None
        self.map: tuple[np.ndarray, np.ndarray] | None = None

    def margins(self, text: Column) -> Column:
        """A double from each text: the sum of its leaves; without trees 0."""
        if self.trees is None:
            return F.lit(0.0)

        @pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            work = text_features(self.lexicon)
            for texts in batches:
                for part in slices(texts):
                    yield pd.Series(self.trees.margin(np.array([work(t or "") for t in texts.iloc[part]], np.float32).astype(float)))

        return run(text)

    def probability(self, margin: Column) -> Column:
        """Probability of a margin: between two places of the map in proportion, beyond them that of the nearest."""

        @pandas_udf("double")
        def run(margins: pd.Series) -> pd.Series:
            if self.map is None:
                return 1 / (1 + np.exp(-margins))
            return pd.Series(np.interp(margins.to_numpy(), *self.map))

        return run(margin)


def id_hash(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def label_rows(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(_id, toxic, part, rank) of labelled ids that are not held out; rank orders them by chance."""
    own = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    own = own.groupBy(F.col(doc_id).alias("_id")).agg((F.max(F.col(label).cast("long")) > 0).alias("toxic"))
    hashed = own.withColumn("_hash", id_hash("_id")).filter(F.col("_hash") % HELD_OUT != 0)
    fold = F.floor(F.col("_hash") / HELD_OUT) % FOLDS
    part = F.when(fold < LEXICON_FOLDS, LEXICON).when(fold < TREE_FOLDS, TREES).otherwise(CALIBRATION)
    return hashed.select("_id", "toxic", part.alias("part"), F.xxhash64("_hash", F.col("_id").cast("string")).alias("rank"))


def sampled_texts(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(toxic, part, text) of the documents that lexicon and trees learn from; no other text is moved."""
    drawn = []
    for part, most in ((LEXICON, LEXICON_SAMPLE), (TREES, TREE_SAMPLE)):
        for toxic in (True, False):
            own = labels.filter((F.col("part") == part) & (F.col("toxic") == toxic))
            drawn.append(own.orderBy("rank", "_id").limit(most))
    wanted = stage(reduce(DataFrame.unionByName, drawn), "toxicity-drawn")  # at most as many rows as the samples have
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    return stage(rows.join(broadcast_if_small(wanted), "_id").select("toxic", "part", "text"), "toxicity-texts")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> Model:
    """Lexicon and trees, from the rows of ``label_rows``."""
    sizes = {(r.part, r.toxic): r.n for r in labels.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, toxic = sum(sizes.values()), sum([n for (_, t), n in sizes.items() if t])
    model = Model(toxic / total if total else 0.0)
    rows = sampled_texts(docs, labels, doc_id, text)
    drawn = {(r.part, r.toxic): r.n for r in rows.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = {part: all(drawn.get((part, t)) for t in (True, False)) for part in (LEXICON, TREES)}
    if both[LEXICON]:
        terms = per_text("terms array<string>", text_terms)(F.col("text"))["terms"]
        each = rows.filter(F.col("part") == LEXICON).select("toxic", F.explode(terms).alias("term"))
        counted = each.groupBy("term").agg(F.count_if("toxic").alias("n_toxic"), F.count_if(~F.col("toxic")).alias("n_clean"))
        model.lexicon = learnt_weights(counted, drawn[LEXICON, True], drawn[LEXICON, False])
    if both[TREES]:
        lexicon = model.lexicon

        def features():
            work = text_features(lexicon)
            return lambda t: (np.array(work(t), np.float32).tobytes(),)

        measured = per_text("x binary", features)(F.col("text"))["x"].alias("x")
        found = rows.filter(F.col("part") == TREES).select("toxic", measured).collect()
        found.sort(key=lambda r: (r.toxic, bytes(r.x)))  # the same trees in whatever order rows come
        x = np.stack([np.frombuffer(r.x, np.float32) for r in found]).astype(float)
        model.trees = Trees().fit(x, np.array([float(r.toxic) for r in found]))
    return model


def calibration(margins: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Map from margins to probabilities, from all labelled documents of its part; ``margins`` has _id and margin."""
    own = labels.filter(F.col("part") == CALIBRATION).select("_id", "toxic")
    inside = F.greatest(F.least("margin", F.lit(MARGIN_RANGE)), F.lit(-MARGIN_RANGE))
    step = F.floor((inside + MARGIN_RANGE) * (MARGINS / 2 / MARGIN_RANGE)).alias("step")
    counts = margins.join(own, "_id").groupBy(step).agg(F.count_if("toxic").alias("hits"), F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    hits, n = np.array([r.hits for r in counts]), np.array([r.n for r in counts])
    if not 0 < hits.sum() < n.sum():
        return None
    return pooled(np.array([(r.step + 0.5) / (MARGINS / 2 / MARGIN_RANGE) - MARGIN_RANGE for r in counts]), hits, n)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each document."""
    known = stage(label_rows(labels, doc_id, label), "toxicity-labels")
    model = fit(docs, known, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), (id_hash(doc_id) % HELD_OUT == 0).alias("held_out"), model.margins(F.col(text)).alias("margin"))
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(model.share))
    else:
        # every text is read once; what follows works on its margin
        rows = stage(rows, "toxicity-margins")
        model.map = calibration(rows.select(F.col("doc_id").alias("_id"), "margin"), known)
        scored = rows.withColumn("score", model.probability(F.col("margin")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
