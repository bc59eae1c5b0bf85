"""Benchmark passages in documents, by a distributed positional inverted index. Spark functions only.

A benchmark item is cut into windows of WINDOW words (a shorter item is one window). Of each window the two
terms that are rarest in the documents are its index terms. Postings (term, document, position) of index
terms are stored, with the words around them. Lists are intersected by their offset-adjusted positions: rows
that agree on document, item and shift are the terms of one alignment. A window occurs if both its terms are
in the alignment and the words around the rarer one are the window's words. Proximity matches are had from
the same alignments (``proximity_matches``).

Index terms go to every task while they are at most MAX_TERMS, and in slices of that many, a pass over the
documents each, beyond. Null and empty texts have no words and no hits. Items without words are left out;
items with one text are looked up once and reported each; an item without an id has the id "". Equal rows
get equal results, one for each row; ids may repeat or be null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import alnum_words, row_key, same_key, stage
from accesslake.operators.joins import broadcast_if_small

WINDOW = 10
MAX_TERMS, MAX_BYTES = 500_000, 32 * 1024 * 1024
KEY = ["doc_id", "_k1", "_k2"]


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words, item_ids): distinct word sequences of the benchmark and the items that have them."""
    words = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), alnum_words(F.col(text)).alias("words"))
    return (
        words.filter(F.size("words") > 0)
        .groupBy("words")
        .agg(F.collect_set("id").alias("item_ids"))
        .withColumn("item", F.substring(F.sha2(F.array_join("words", " "), 256), 1, 32))
    )


def sliced(terms: DataFrame) -> list[DataFrame]:
    """Term tables that each fit every task; one unless there are very many."""
    slices = -(-terms.count() // MAX_TERMS)
    if slices < 2:
        return [F.broadcast(terms)]
    part = F.pmod(F.xxhash64("term"), F.lit(slices))
    return [F.broadcast(terms.filter(part == i)) for i in range(slices)]


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def term_counts(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(term, n): occurrences of each term in all documents."""
    words = docs.select(F.explode(alnum_words(F.col(text))).alias("term"))
    return union_all([words.join(t, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")) for t in sliced(terms)])


def benchmark_windows(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words, item_ids, windows): windows that can occur, each with the positions of its two rarest terms."""
    each = items.select("item", F.posexplode("words").alias("at", "term"))
    counted = each.join(counts, "term", "left").groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("terms")
    )
    size = F.size("terms")
    length = F.least(size, F.lit(window))

    def one(start: Column) -> Column:
        ranked = F.array_sort(F.transform(F.slice("terms", start + 1, length), lambda t: F.struct(t["n"].alias("n"), t["term"].alias("term"), t["at"].alias("at"))))
        return F.struct(
            start.alias("start"), length.alias("length"), ranked[0]["n"].alias("least"), ranked[0]["at"].alias("p1"),
            F.when(length > 1, ranked[1]["at"]).otherwise(ranked[0]["at"]).alias("p2"),
        )

    windows = F.filter(F.transform(F.sequence(F.lit(0), size - length), one), lambda w: w["least"] > 0)
    found = counted.select("item", windows.alias("windows")).filter(F.size("windows") > 0)
    return items.join(found, "item")


def index_terms(windows: DataFrame) -> DataFrame:
    """(item, at, term, first) for the positions that some window is found by; first: as its rarest term."""
    each = windows.select("item", "words", F.explode("windows").alias("w"))
    both = each.select("item", "words", F.explode(F.array(F.struct(F.col("w.p1").alias("at"), F.lit(True).alias("first")), F.struct(F.col("w.p2").alias("at"), F.lit(False).alias("first")))).alias("x"))
    return both.groupBy("item", F.col("x.at").alias("at"), F.col("words")[F.col("x.at")].alias("term")).agg(F.max("x.first").alias("first"))


def postings(docs: DataFrame, terms: DataFrame, doc_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """The index: (term, document key, pos, before, context) of all occurrences of the terms.

    ``context`` holds the words that a window around the term can reach, for terms that need it;
    ``before`` of them come before the term.
    """
    words = docs.select(*row_key(doc_id, text), alnum_words(F.col(text)).alias("words"))
    each = words.select(*KEY, "words", F.posexplode("words").alias("pos", "term"))
    before = F.least("pos", F.lit(window - 1))
    context = F.when(F.col("first"), F.slice("words", F.col("pos") - before + 1, before + window))
    found = [each.join(t, "term").select("term", *KEY, "pos", before.alias("before"), context.alias("context")) for t in sliced(terms)]
    return union_all(found)


def alignments(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(document key, item, shift, ats, contexts): the positions of an item that agree on one shift in a document.

    As many as the item has index terms at most; equal rows of a document fold before the shuffle.
    """
    item_terms = broadcast_if_small(terms.select("item", "at", "term"), MAX_TERMS, MAX_BYTES)
    lists = index.join(item_terms, "term").select(*KEY, "item", (F.col("pos") - F.col("at")).alias("shift"), "at", "before", "context")
    seen = F.when(F.col("context").isNotNull(), F.struct("at", "before", "context"))
    return lists.groupBy(*KEY, "item", "shift").agg(F.collect_set("at").alias("ats"), F.collect_set(seen).alias("contexts"))


def phrase_hits(aligned: DataFrame, windows: DataFrame) -> DataFrame:
    """(document key, item_ids, spans): windows of an item that occur, as word ranges, end exclusive."""
    joined = aligned.join(broadcast_if_small(windows, MAX_TERMS, MAX_BYTES), "item")

    def occurs(w: Column) -> Column:
        own = F.slice("words", w["start"] + 1, w["length"])
        around = lambda c: (c["at"] == w["p1"]) & (c["before"] >= w["p1"] - w["start"]) & (
            F.slice(c["context"], F.greatest(F.lit(1), c["before"] - (w["p1"] - w["start"]) + 1), w["length"]) == own
        )
        both = F.array_contains("ats", w["p1"]) & F.array_contains("ats", w["p2"])
        return both & F.exists("contexts", around)

    spans = F.transform(
        F.filter("windows", occurs),
        lambda w: F.struct((F.col("shift") + w["start"]).alias("s"), (F.col("shift") + w["start"] + w["length"]).alias("e")),
    )
    return joined.select(*KEY, "item_ids", spans.alias("spans")).filter(F.size("spans") > 0)


def proximity_matches(aligned: DataFrame, within: int, least: int = 2) -> DataFrame:
    """(document key, item, first, last): ``least`` or more index terms of an item within some words of a document.

    Alignments of one item whose shifts differ by less than ``within`` are one match.
    """
    each = aligned.select(*KEY, "item", F.explode("ats").alias("at"), "shift")
    block = F.floor(F.col("shift") / within)
    near = each.select("*", F.explode(F.array(block, block + 1)).alias("block"))
    return (
        near.groupBy(*KEY, "item", "block")
        .agg(F.count_distinct("at").alias("terms"), F.min(F.col("shift") + F.col("at")).alias("first"), F.max(F.col("shift") + F.col("at")).alias("last"))
        .filter(F.col("terms") >= least)
        .groupBy(*KEY, "item", "first", "last").agg(F.max("terms").alias("terms"))
    )


def covered(spans: Column) -> Column:
    """Words inside the union of ranges."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("e"))
    step = lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["e"]))).cast("long").alias("n"), F.greatest(a["e"], x["e"]).alias("e")
    )
    return F.aggregate(F.array_sort(F.array_distinct(spans)), zero, step, lambda a: a["n"])


def alignment_tables(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, window: int) -> tuple[DataFrame, DataFrame]:
    items = stage(benchmark_items(benchmark, item_id, text), "bench-items")
    vocabulary = items.select(F.explode("words").alias("term")).distinct()
    windows = stage(benchmark_windows(items, term_counts(docs, vocabulary, text), window), "bench-windows")
    terms = stage(index_terms(windows), "bench-terms")
    wanted = terms.groupBy("term").agg(F.max("first").alias("first"))
    index = stage(postings(docs, wanted, doc_id, text, window), "postings")
    return alignments(index, terms), windows


def document_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """(document key, n_hit, items) of the documents that hold a window."""
    aligned, windows = alignment_tables(docs, benchmark, doc_id, text, item_id, window)
    hits = phrase_hits(aligned, windows).groupBy(*KEY)
    found = hits.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("items"))
    return found.select(*KEY, covered(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("items"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids, sorted as strings), contaminated."""
    hits = stage(document_hits(docs, benchmark, doc_id, text, item_id, window), "contaminated")
    base = docs.select(*row_key(doc_id, text), F.size(alnum_words(F.col(text))).cast("long").alias("n_words"))
    joined = base.alias("a").join(hits.alias("b"), same_key("a", "b"), "left")
    n_hit = F.coalesce("b.n_hit", F.lit(0).cast("long"))
    items = F.coalesce("b.items", F.array().cast("array<string>"))
    return joined.select("a.doc_id", "a.n_words", n_hit.alias("n_hit"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """Documents without any window of the benchmark, unchanged."""
    hits = stage(document_hits(docs, benchmark, doc_id, text, item_id, window).select(*KEY), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, *row_key(doc_id, text)).alias("a")
    return keyed.join(broadcast_if_small(hits).alias("b"), same_key("a", "b"), "left_anti").select("row.*")
