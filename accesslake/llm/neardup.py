"""Near-duplicate documents by a chosen-path set-similarity join.

A document is its set of SHINGLE-word shingles, as 64-bit hashes; equal sets are one vertex, whatever the
number of copies. A vertex has COORDINATES minwise tokens. TREES independent trees choose a token each, which
names a node; a pair at the threshold shares no node with probability 0.15^8 = 3e-7. Nodes with at most SMALL vertices
are compared exhaustively. Large ones link every vertex to a central one, the vertex nearest to the majority of the
node's sketch bits, so that thousands of near copies are one component with a link each.

Then large nodes are compared exhaustively too, between components: blocks of BLOCK vertices against each
other, in numpy on sizes and sketches. A first round confirms the NEAREST partners of each vertex, which joins most of
what is to be joined; a second one takes every candidate whose ends are still apart, compares the full sets in the task
and hands out a forest of the links that join components. No pair of a node is left out, so recall does not depend on a
group's size; comparing a node takes time with the square of its size, memory with BLOCK, and rows with its size.

Candidates pass a size filter, which is exact, and a filter on 128 one-bit sketches, 4.5 deviations wide, those of large nodes also one on the
last bytes of the 128 minwise tokens, 4.7 deviations wide, and are confirmed on the full sets: 100 * |both| >= PERCENT * |either|. Components come from the confirmed links by
hooking and pointer jumping; links found later join the components of earlier ones.

A text without words has an empty set and is linked with nothing; fewer words than SHINGLE are one shingle.
Null texts are empty. Equal rows are copies of each other. Rows with a null id take part like others: a
component's id is its smallest id, or null if it has none. Other columns are not touched.
"""

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import per_text, stage
from accesslake.operators.joins import broadcast_if_small

SHINGLE, PERCENT = 5, 85
COORDINATES, TREES, SMALL = 128, 8, 8
#: Vertices of a block of a large node, and partners of each vertex in a block that the first round confirms.
BLOCK, NEAREST = 4096, 8
#: Shingles of a block whose members have their full sets beside them.
BLOCK_SHINGLES = 1 << 20
#: Equal sketch bits, and equal last bytes of minwise tokens, of 128, that a candidate has at least.
CANDIDATE_BITS, CANDIDATE_TOKENS = 105, 90
MAX_ROWS, MAX_BYTES = 1_000_000, 96 * 1024 * 1024
#: Links of a graph whose labels go to every task, and labels that one task then writes.
GRAPH_LINKS, GRAPH_ROWS = 100_000, 25_000
HASH_BLOCK = 1 << 18
BYTE_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    """A random number for each byte of a word, the same for A-Z and a-z; 0 for white space."""
    values = np.random.default_rng(10).integers(1, 1 << 63, 256, np.uint64)
    values[65:91] = values[97:123]
    values[[9, 10, 11, 12, 13, 32]] = 0
    return values


def powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64))))


class WordHashes:
    """64-bit hashes of a text's lower-cased words: polynomials over its bytes, by differences of prefix sums.

    Long texts are worked on in blocks that end between words.
    """

    BASE = 0xD1342543DE82EF95

    def __init__(self):
        self.values, self.limit = byte_values(), 0
        self.grow(HASH_BLOCK)

    def grow(self, n: int) -> None:
        self.limit = n
        self.up, self.down = powers(self.BASE, n), powers(pow(self.BASE, -1, 1 << 64), n)

    def block(self, raw: bytes) -> np.ndarray:
        if len(raw) > self.limit:
            self.grow(len(raw))
        value = self.values[np.frombuffer(raw, np.uint8)]
        inside = np.concatenate(([False], value != 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        sums = np.concatenate(([np.uint64(0)], np.cumsum(value * self.up[: len(value)])))
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def __call__(self, text: str) -> np.ndarray:
        raw, parts, at = text.encode("utf-8", "surrogatepass"), [], 0
        while at < len(raw):
            stop = at + HASH_BLOCK
            if stop < len(raw):
                gap = BYTE_SPACE.search(raw, stop)
                stop = gap.start() if gap else len(raw)
            parts.append(self.block(raw[at:stop]))
            at = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of word hashes; they depend on the words and their order."""
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)])
    return np.unique(out)


def shingler() -> Callable[[str], np.ndarray]:
    words = WordHashes()
    return lambda t: shingle_set(words(t))


def coordinates() -> np.ndarray:
    """Odd factors: each orders the 64-bit hashes in its own way."""
    return np.random.default_rng(20).integers(1, 1 << 63, COORDINATES, np.uint64) << np.uint64(1) | np.uint64(1)


def minwise(hashes: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The smallest product of each coordinate; long sets are worked on in blocks."""
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(best, np.multiply.outer(a, hashes[at : at + 512]).min(axis=1), out=best)
    return best


def signatures(text: Column) -> Column:
    """Struct of n_shingles, the set's digest, minwise tokens, their last bytes and two words of one-bit sketch; nothing for empty sets."""

    def make():
        shingles, factors = shingler(), coordinates()

        def work(t: str) -> tuple:
            found = shingles(t)
            if not len(found):
                return 0, None, None, None, None, None
            tokens = minwise(found, factors)
            bits = np.packbits((mix(tokens) & np.uint64(1)).astype(np.uint8)).view(np.int64)
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            mixed = (mix(tokens) >> np.uint64(33)).astype(np.int32)
            return len(found), digest, mixed, mixed.astype(np.uint8).tobytes(), int(bits[0]), int(bits[1])

        return work

    return per_text("n_shingles long, digest binary, tokens array<int>, ends binary, s1 long, s2 long", make)(text)


def row_hash(doc_id: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull())


def signed_documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, r1, r2, n_shingles, digest, tokens, s1, s2) of every row, stored; r1 and r2 tell rows apart."""
    signed = docs.select(
        F.col(doc_id).alias("doc_id"), row_hash(doc_id, text, 1).alias("r1"), row_hash(doc_id, text, 2).alias("r2"),
        signatures(F.col(text)).alias("x"),
    )
    return stage(signed.select("doc_id", "r1", "r2", "x.*"), "near-signed")


def vertices(signed: DataFrame) -> DataFrame:
    """One row per distinct set: v, size n, smallest doc_id, one row's hashes, tokens and sketch; copies fold before the shuffle."""
    rows = signed.filter("digest is not null").withColumnRenamed("digest", "v").groupBy("v")
    return rows.agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.min(F.struct("r1", "r2")).alias("row"),
        F.first("s1").alias("s1"), F.first("s2").alias("s2"), F.first("tokens").alias("tokens"), F.first("ends").alias("ends"),
    )


OWN = ["v", "n", "s1", "s2"]


def tree_nodes() -> list[Column]:
    """A vertex's node in each tree: a tree chooses a coordinate, whose token names the node."""

    def child(tree: int) -> Column:
        root = F.lit(tree).cast("long")
        picked = F.pmod(F.xxhash64(root, F.lit(0), F.lit(0)), F.lit(COORDINATES)).cast("int")
        return F.xxhash64(root, F.lit(0), F.col("tokens")[picked])

    return [child(t) for t in range(TREES)]


def first_nodes(points: DataFrame) -> DataFrame:
    """Members of the trees' nodes."""
    return points.select(*OWN, "mark", F.explode(F.array(*tree_nodes())).alias("node"))


def equal_bits(a: str, b: str) -> Column:
    return 128 - F.bit_count(F.col(f"{a}.s1").bitwiseXOR(F.col(f"{b}.s1"))) - F.bit_count(F.col(f"{a}.s2").bitwiseXOR(F.col(f"{b}.s2")))


def alike(a: str, b: str) -> Column:
    """Filters that a pair at the threshold passes: sizes exactly, sketches but for chance."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(x, y) >= PERCENT * F.greatest(x, y)) & (equal_bits(a, b) >= CANDIDATE_BITS)


def pairs_of(rows: DataFrame) -> DataFrame:
    """(a, b) of the structs x and y, smaller digest first."""
    pairs = rows.filter((F.col("x.v") != F.col("y.v")) & alike("x", "y"))
    return pairs.select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b"))


def small_node_pairs(members: DataFrame, most: int) -> DataFrame:
    """All pairs of nodes with so many members at most whose components differ."""
    nodes = members.filter(F.col("size") <= most).groupBy("node").agg(F.collect_list(F.struct(*OWN, "mark")).alias("all"))
    first = nodes.select("all", F.posexplode("all").alias("i", "x"))
    each = first.select("x", F.explode(F.slice("all", F.col("i") + 2, most)).alias("y"))
    return pairs_of(each.filter(F.col("x.mark") != F.col("y.mark"))).distinct()


def node_members(here: DataFrame) -> DataFrame:
    """Members of nodes of two or more components, with the node's size."""
    nodes = here.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("mark").alias("lo"), F.max("mark").alias("hi"))
    return here.join(nodes.filter("lo != hi").select("node", "size"), "node")


def central_pairs(large: DataFrame) -> DataFrame:
    """Pairs of each member of a large node with the member nearest to the majority of its sketch bits."""
    ones = [F.expr(f"sum(shiftright({word}, {i}) & 1) AS {word}_{i}") for word in ("s1", "s2") for i in range(64)]
    votes = large.groupBy("node").agg(F.count(F.lit(1)).alias("members"), *ones)

    def majority(word: str) -> Column:
        return F.expr(" | ".join(f"shiftleft(bigint(2 * {word}_{i} > members), {i})" for i in range(64)))

    middle = stage(votes.select("node", F.struct(majority("s1").alias("s1"), majority("s2").alias("s2")).alias("m")), "near-middle")
    own = large.select("node", F.struct(*OWN).alias("x"))
    ranked = own.join(middle, "node").groupBy("node").agg(F.max(F.struct(equal_bits("x", "m").alias("bits"), F.col("x.v").alias("v"), F.col("x").alias("y"))).alias("best"))
    return pairs_of(own.join(ranked.select("node", F.col("best.y").alias("y")), "node")).distinct()


class Block:
    """Members of a node's block as arrays."""

    def __init__(self, rows: pd.DataFrame, number: int):
        own = rows[rows["block"] == number]
        self.v, self.n, self.mark = own["v"].to_numpy(object), own["n"].to_numpy(), own["mark"].to_numpy()
        self.sketch = own[["s1", "s2"]].to_numpy(np.int64).view(np.uint64)
        self.ends = np.frombuffer(b"".join(own["ends"]), np.uint8).reshape(len(own), COORDINATES)
        self.nodes = np.array(own["nodes"].tolist(), np.int64).reshape(len(own), TREES)
        if "shingles" in own:
            self.sets = [np.asarray(x, np.int64) for x in own["shingles"]]


def candidates(x: Block, y: Block, node: int, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places p in x from ``at`` on, and q in y, of candidates between components, with their equal tokens.

    A pair that shares the node of an earlier tree is a candidate there, and not here.
    """
    rest = slice(at, at + 256)
    apart = sum(np.bitwise_count(x.sketch[rest, k, None] ^ y.sketch[None, :, k]).astype(np.int16) for k in (0, 1))
    sizes = 100 * np.minimum(x.n[rest, None], y.n) >= PERCENT * np.maximum(x.n[rest, None], y.n)
    found = np.argwhere(sizes & (apart <= COORDINATES - CANDIDATE_BITS) & (x.mark[rest, None] != y.mark))
    kept = []
    for some in np.array_split(found, 1 + len(found) // 65_536):
        p, q = some[:, 0] + at, some[:, 1]
        equal = (x.ends[p] == y.ends[q]).sum(axis=1)
        shared = (x.nodes[p] == y.nodes[q]).argmax(axis=1)
        good = (equal >= CANDIDATE_TOKENS) & (x.nodes[p, shared] == node)
        kept.append(np.stack([p[good], q[good], equal[good]]))
    return tuple(np.concatenate(kept, axis=1))


def each_candidates(rows: pd.DataFrame):
    """The two blocks of a group of rows and the candidates of some of the first one's members at a time."""
    node = rows["node"].iloc[0]
    x = Block(rows, rows["i"].iloc[0])
    y = x if rows["i"].iloc[0] == rows["j"].iloc[0] else Block(rows, rows["j"].iloc[0])
    for at in range(0, len(x.v), 256):
        yield x, y, *candidates(x, y, node, at)


def nearest_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Candidate pairs (a, b): of each member those with the NEAREST partners in the other block."""
    found = set()
    for x, y, p, q, equal in each_candidates(rows):
        for side in (p, q):
            order = np.lexsort((-equal, side))
            first = np.searchsorted(side[order], side[order])
            best = order[np.arange(len(order)) - first < NEAREST]
            found.update((min(a, b), max(a, b)) for a, b in ((bytes(x.v[i]), bytes(y.v[k])) for i, k in zip(p[best], q[best])))
    return pd.DataFrame(sorted(found), columns=["a", "b"])


def members_with_candidates(rows: pd.DataFrame) -> pd.DataFrame:
    """(node, v) of members that have a candidate."""
    found = set()
    for x, y, p, q, _ in each_candidates(rows):
        found.update(map(bytes, x.v[np.unique(p)]))
        found.update(map(bytes, y.v[np.unique(q)]))
    return pd.DataFrame({"node": rows["node"].iloc[0], "v": sorted(found)})


def number_shingles(x: Block, y: Block) -> int:
    """Small numbers, the same in both blocks, take the place of their shingles; returns how many there are."""
    blocks = [x] if x is y else [x, y]
    sets = [s for block in blocks for s in block.sets]
    found, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    numbered = np.split(numbers, np.cumsum([len(s) for s in sets])[:-1])
    for block in blocks:
        block.sets, numbered = numbered[: len(block.sets)], numbered[len(block.sets) :]
    return len(found)


def joining_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between two blocks, on full sets, that join components: with these, all linked ones are joined."""
    above: dict[int, int] = {}
    own = None

    def top(mark: int) -> int:
        while above.get(mark, mark) != mark:
            mark = above[mark]
        return mark

    found = []
    for x, y, p, q, _ in each_candidates(rows):
        if own is None:
            own = np.zeros(number_shingles(x, y), bool)
        for i in np.unique(p):
            open_ = [k for k in q[p == i] if not above or top(x.mark[i]) != top(y.mark[k])]
            if not open_:
                continue
            sets = [y.sets[k] for k in open_]
            starts = np.concatenate(([0], np.cumsum([len(z) for z in sets])[:-1]))
            own[x.sets[i]] = True
            both = np.add.reduceat(own[np.concatenate(sets)], starts, dtype=np.int64)
            own[x.sets[i]] = False
            for k, z, n in zip(open_, sets, both):
                if 100 * n >= PERCENT * (len(x.sets[i]) + len(z) - n) and top(x.mark[i]) != top(y.mark[k]):
                    above[top(x.mark[i])] = top(y.mark[k])
                    found.append((bytes(x.v[i]), bytes(y.v[k])))
    return pd.DataFrame([(min(e), max(e)) for e in found], columns=["a", "b"])


def block_groups(members: DataFrame) -> DataFrame:
    """Members of nodes dealt into blocks, once for every block theirs is compared with; grouped by node and pair of blocks.

    Members without their node's size are counted, and their shingles too.
    """
    columns = [c for c in members.columns if c != "size"]
    if "size" in members.columns:
        sized = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    else:
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        sized = members.join(members.groupBy("node").agg(blocks.alias("blocks")), "node")
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("node", "v"), F.col("blocks")))
    other = dealt.select(*columns, "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    return other.select(*columns, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).groupBy("node", "i", "j")


def open_members(points: DataFrame, large: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of large nodes of two or more components by now, with the node's size, tokens and the nodes of all trees."""
    known = labels.select("v", F.xxhash64("label").alias("_mark"))
    marked = large.drop("mark", "size").join(known, "v", "left").withColumn("mark", F.coalesce("_mark", F.xxhash64("v"))).drop("_mark")
    more = points.select("v", "ends", F.array(*tree_nodes()).alias("nodes"))
    return node_members(marked).join(more, "v").select("node", "size", *OWN, "mark", "ends", "nodes")


def block_pairs(points: DataFrame, large: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs of large nodes, the nearest ones of each member in each block."""
    pairs = block_groups(open_members(points, large, labels)).applyInPandas(nearest_pairs, "a binary, b binary")
    return stage(pairs.distinct(), "near-candidates")


def remaining_links(docs: DataFrame, points: DataFrame, large: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Links that join components, from all candidates of large nodes whose ends are apart.

    First only the members that have any are found. These are compared again with their full sets beside them, and
    of each pair of blocks a forest comes out: no candidate leaves its task.
    """
    members = stage(open_members(points, large, labels), "near-open")
    touched = block_groups(members).applyInPandas(members_with_candidates, "node long, v binary").distinct()
    touched = stage(touched, "near-touched")
    sets = full_sets(docs, points, touched.select("v").distinct(), doc_id, text)
    own = members.join(touched, ["node", "v"]).join(sets, "v")
    links = block_groups(own.select(*members.columns, "shingles").drop("size")).applyInPandas(joining_links, "a binary, b binary")
    return stage(links.distinct(), "near-links")


def first_pairs(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of the first level, and the members of its large nodes."""
    marked = points.withColumn("mark", F.xxhash64("v"))
    kept = stage(node_members(first_nodes(marked)), "near-nodes")
    large = kept.filter(F.col("size") > SMALL)
    found = small_node_pairs(kept, SMALL) if large.isEmpty() else small_node_pairs(kept, SMALL).unionByName(central_pairs(large)).distinct()
    return stage(found, "near-candidates"), large


def full_sets(docs: DataFrame, points: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(v, shingles) of the sets of some vertices, each from one of its texts.

    The wanted rows go to every task while there are at most MAX_ROWS; beyond, the texts are shuffled.
    """
    rows = stage(points.join(wanted, "v").select("v", "row.r1", "row.r2"), "near-wanted")
    texts = docs.select(row_hash(doc_id, text, 1).alias("r1"), row_hash(doc_id, text, 2).alias("r2"), F.col(text).alias("text"))
    own = texts.join(broadcast_if_small(rows, MAX_ROWS, MAX_BYTES), ["r1", "r2"]).select("v", "text").dropDuplicates(["v"])

    def make():
        shingles = shingler()
        return lambda t: (shingles(t).view(np.int64),)

    return stage(own.select("v", per_text("shingles array<long>", make)(F.col("text")).getField("shingles").alias("shingles")), "near-sets")


def confirmed(docs: DataFrame, points: DataFrame, pairs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The pairs that are links, on their full sets."""
    sets = full_sets(docs, points, pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct(), doc_id, text)
    left = sets.select(F.col("v").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("v").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return stage(both.filter(100 * F.col("both") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """(v, label) of all linked vertices; the label is the component's smallest vertex.

    Each round tells every vertex, and the vertex it points to, its grandparent and those of its neighbours, and so
    shortens paths; the number of rounds grows with the logarithm of the longest path. The smallest vertex keeps its
    own label, so all is done when no link has two labels. The labels of up to GRAPH_LINKS links go to every task, so
    that a round is one shuffle and one table.
    """
    count = links.count()
    small = count <= GRAPH_LINKS

    def sent(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if small else rows

    def least(told: DataFrame) -> DataFrame:
        found = told.select("x.*").groupBy("v").agg(F.min("label").alias("label"))
        return stage(found.coalesce(1 + 2 * count // GRAPH_ROWS) if small else found, "near-labels")

    def tell(*pairs: tuple) -> Column:
        return F.explode(F.array(*[F.struct(F.col(v).alias("v"), F.col(label).alias("label")) for v, label in pairs])).alias("x")

    labels = least(links.select("a", "b", F.least("a", "b").alias("low")).select(tell(("a", "low"), ("b", "low"))))
    while True:
        la, lb = (sent(labels.select(F.col("v").alias(end), F.col("label").alias(f"l{end}"))) for end in "ab")
        if links.join(la, "a").join(lb, "b").filter("la != lb").isEmpty():
            return labels
        up = labels.select(F.col("v").alias("label"), F.col("label").alias("grand"))
        known = labels.join(sent(up), "label")
        known = known if small else stage(known, "near-grand")
        a, b = (sent(known.select(F.col("v").alias(end), F.col("label").alias(f"l{end}"), F.col("grand").alias(f"g{end}"))) for end in "ab")
        offers = links.join(a, "a").join(b, "b").select(tell(("a", "gb"), ("b", "ga"), ("la", "gb"), ("lb", "ga")))
        labels = least(known.select(tell(("v", "grand"), ("label", "grand"))).unionByName(offers))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(v, label) after more links; only components that these join are worked on, each as its smallest vertex."""
    la, lb = (labels.select(F.col("v").alias(end), F.col("label").alias(f"l{end}")) for end in "ab")
    x, y = F.coalesce("la", "a"), F.coalesce("lb", "b")
    ends = links.join(la, "a", "left").join(lb, "b", "left").filter(x != y)
    apart = stage(ends.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "near-apart")
    if apart.isEmpty():
        return labels
    tops = components(apart).select(F.col("v").alias("label"), F.col("label").alias("top"))
    after = labels.join(tops, "label", "full").select(F.coalesce("v", "label").alias("v"), F.coalesce("top", "label").alias("label"))
    return stage(after, "near-labels")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, r1, r2, n_shingles, class, component_id) of every row; class is null for empty sets."""
    signed = signed_documents(docs, doc_id, text)
    points = stage(vertices(signed), "near-points")
    early, large = first_pairs(points)
    labels = components(confirmed(docs, points, early, doc_id, text))
    if not large.isEmpty():
        labels = joined(labels, confirmed(docs, points, block_pairs(points, large, labels), doc_id, text))
        rest = remaining_links(docs, points, large, labels, doc_id, text)
        labels = labels if rest.isEmpty() else joined(labels, rest)
    named = points.select("v", "doc_id").join(labels, "v", "left").select("v", "doc_id", F.coalesce("label", "v").alias("class"))
    named = stage(named, "near-named")
    ids = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    by_set = named.select("v", "class").join(ids, "class")
    found = signed.select("doc_id", "r1", "r2", "n_shingles", F.col("digest").alias("v")).join(by_set, "v", "left")
    own = F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "r1", "r2", "n_shingles", "class", own.alias("component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    found = near_duplicate_classes(docs, doc_id, text)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with one row of each class: the smallest id, then any of its equal rows. Empty texts stay, equal rows of them once."""
    found = near_duplicate_classes(docs, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "r1", "r2")
    first = found.filter("class is not null").groupBy("class").agg(F.min(order).alias("first")).select("first.r1", "first.r2")
    stay = stage(first.unionByName(found.filter("class is null").select("r1", "r2").distinct()), "near-stay")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, row_hash(doc_id, text, 1).alias("r1"), row_hash(doc_id, text, 2).alias("r2"))
    return keyed.join(stay, ["r1", "r2"]).dropDuplicates(["r1", "r2"]).select("row.*")
