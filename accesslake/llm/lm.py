"""Language-model scores of documents: stupid backoff from piece pairs to single pieces.

Texts are encoded with a public piece vocabulary, so ids and pairs are exact numbers. Map tasks turn
documents into packs: for each hash bucket of pairs, the distinct pairs and the documents that use them.
Pair counts are summed per bucket, FAN_IN packs at a time, so that a task holds as many and no more however many
packs there are. They are joined back to the packs by bucket, with a copy of the table for each JOIN_PACKS
packs, and each document's logarithms are summed. Piece counts have at most as many rows as the vocabulary and
go to every task.

A pair (u, v) that also occurs outside the document scores (count(u, v) - own count) / count(u); any
other backs off to BACKOFF * count(v) / all pieces. Each text starts with the model's begin piece. Counts
cover every piece of every row, copies included. An empty or null text has no pieces, score 0 and a null
mean. Rows keep their ids whatever they are: null, repeated or of another type than numbers.
"""

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.pieces import byte_pairs, default_model, encode_text
from accesslake.llm.texts import stage, wide_rows
from accesslake.operators.joins import broadcast_if_small

BEGIN = 1
BACKOFF = 0.4
PACK_TOKENS, PACK_DOCS = 1_500_000, 60_000
MIN_BUCKETS, MAX_BUCKETS, BUCKET_BYTES = 64, 1024, 16 * 1024 * 1024
FAN_IN, JOIN_PACKS = 64, 16_384
BROADCAST_BYTES = 24 * 1024 * 1024

PACK = (
    "pack string, bucket int, pairs binary, totals binary, users binary, docs binary, uses binary, n_docs int, "
    "doc_ids array<string>, n_tokens array<long>, pieces array<int>, firsts array<long>, counts array<long>"
)
PART = "pack string, bucket int, docs binary, score binary, seen binary, doc_ids array<string>, n_tokens array<long>"


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the size of the input; pairs in a bucket are bounded by the vocabulary anyway."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(MIN_BUCKETS, min(MAX_BUCKETS, size // BUCKET_BYTES))


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return mixed % np.uint64(buckets)


def _pack(ids: list[str], encoded: list[np.ndarray], buckets: int) -> list[dict]:
    """Rows of one pack: one for each bucket it has pairs in, and one with its documents and piece counts."""
    name, sizes = uuid.uuid4().hex, np.array([len(e) for e in encoded], np.int64)
    tokens = np.concatenate(encoded).astype(np.uint64) if sizes.sum() else np.zeros(0, np.uint64)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = BEGIN
    pieces, counts = np.unique(tokens, return_counts=True)
    heads, firsts = np.unique(before, return_counts=True)
    known = np.union1d(pieces, heads)
    head_of, count_of = dict(zip(heads.tolist(), firsts.tolist())), dict(zip(pieces.tolist(), counts.tolist()))
    rows = [{
        "pack": name, "bucket": -1, "n_docs": len(ids), "doc_ids": ids, "n_tokens": sizes, "pieces": known.astype(np.int32),
        "firsts": [head_of.get(p, 0) for p in known.tolist()], "counts": [count_of.get(p, 0) for p in known.tolist()],
    }]
    pairs = before << np.uint64(16) | tokens
    doc = np.repeat(np.arange(len(ids), dtype=np.uint64), sizes)
    order = np.sort(bucket_of(pairs, buckets) << np.uint64(48) | pairs << np.uint64(16) | doc)
    if not len(order):
        return rows
    first = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
    uses = np.diff(np.append(first, len(order)))
    entry = order[first]
    at = np.flatnonzero(np.concatenate(([True], entry[1:] >> np.uint64(16) != entry[:-1] >> np.uint64(16))))
    users, totals = np.diff(np.append(at, len(entry))), np.add.reduceat(uses, at)
    pair = entry[at] >> np.uint64(16) & np.uint64(0xFFFFFFFF)
    bucket = entry[at] >> np.uint64(48)
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for a, b in zip(cut, np.append(cut[1:], len(bucket))):
        x, y = at[a], at[b] if b < len(at) else len(entry)
        rows.append({
            "pack": name, "bucket": int(bucket[a]), "n_docs": len(ids), "pairs": pair[a:b].astype(np.uint32).tobytes(),
            "totals": totals[a:b].astype(np.uint32).tobytes(), "users": users[a:b].astype(np.uint32).tobytes(),
            "docs": (entry[x:y] & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), "uses": uses[x:y].astype(np.uint32).tobytes(),
        })
    return rows


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame([tuple(r.get(n) for n in names) for r in rows], columns=names, dtype=object)


def packs(docs: DataFrame, doc_id: str, text: str, model_path: str, buckets: int) -> DataFrame:
    """Packs of documents by bucket."""
    names = [part.split()[0] for part in PACK.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, memo = byte_pairs(model_path)
        ids, encoded, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch["doc_id"], batch["text"]):
                ids.append(i)
                encoded.append(encode_text(memo, t or ""))
                held += len(encoded[-1])
                if held >= PACK_TOKENS or len(ids) >= PACK_DOCS:
                    yield _frame(_pack(ids, encoded, buckets), names)
                    ids, encoded, held = [], [], 0
        if ids:
            yield _frame(_pack(ids, encoded, buckets), names)

    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, PACK)


def _add_up(kind: type):
    """Counts of all pairs in some rows of one bucket, from counts of that kind."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        pairs, sums = np.frombuffer(b"".join(rows["pairs"]), np.uint32), np.frombuffer(b"".join(rows["sums"]), kind)
        distinct, where = np.unique(pairs, return_inverse=True)
        total = np.bincount(where, sums, len(distinct)).astype(np.int64)
        return pd.DataFrame({**{c: [rows[c].iloc[0]] for c in ("bucket", "part")}, "pairs": [distinct.tobytes()], "sums": [total.tobytes()]})

    return run


def pair_counts(packed: DataFrame, n_packs: int) -> DataFrame:
    """The count table: for each bucket its pairs, sorted, and their counts."""
    parts = max(1, -(-n_packs // FAN_IN))
    part = F.pmod(F.xxhash64("pack"), F.lit(parts))
    rows, kind = packed.filter("bucket >= 0").select("bucket", part.alias("part"), "pairs", F.col("totals").alias("sums")), np.uint32
    while True:
        rows = rows.groupBy("bucket", "part").applyInPandas(_add_up(kind), "bucket int, part long, pairs binary, sums binary")
        if parts == 1:
            return rows.select("bucket", F.col("pairs").alias("known"), "sums")
        parts, kind = -(-parts // FAN_IN), np.int64
        rows = stage(rows, "lm-partial").withColumn("part", F.pmod("part", F.lit(parts)))


def piece_counts(packed: DataFrame) -> dict[int, tuple[int, int]]:
    """How often each piece stands before another, and how often it occurs; no more rows than the vocabulary."""
    each = packed.filter("bucket = -1").select(F.explode(F.arrays_zip("pieces", "firsts", "counts")).alias("x")).select("x.*")
    rows = each.groupBy("pieces").agg(F.sum("firsts").alias("f"), F.sum("counts").alias("c")).collect()
    return {r.pieces: (r.f, r.c) for r in rows}


def _score_parts(counts: dict[int, tuple[int, int]], backoff: float):
    top = max(counts, default=0) + 1
    first, own = np.ones(top), np.ones(top)
    for piece, (f, c) in counts.items():
        first[piece], own[piece] = max(f, 1), max(c, 1)
    log_first, log_own = np.log(first), np.log(own)
    base = math.log(backoff) - math.log(max(1, sum(c for _, c in counts.values())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                pairs, users = np.frombuffer(r.pairs, np.uint32), np.frombuffer(r.users, np.uint32)
                docs, uses = np.frombuffer(r.docs, np.uint16), np.frombuffer(r.uses, np.uint32).astype(np.float64)
                known, sums = np.frombuffer(r.known, np.uint32), np.frombuffer(r.sums, np.int64)
                total = np.repeat(sums[np.searchsorted(known, pairs)], users)
                hit = total > uses
                u, v = np.repeat(pairs >> 16, users), np.repeat(pairs & 0xFFFF, users)
                value = np.where(hit, np.log(np.maximum(total - uses, 1)) - log_first[u], base + log_own[v])
                some, at = np.unique(docs, return_inverse=True)
                score, seen = np.bincount(at, value * uses, len(some)), np.bincount(at, hit * uses, len(some))
                out.append((r.pack, r.bucket, some.tobytes(), score.tobytes(), seen.astype(np.int32).tobytes(), None, None))
            yield pd.DataFrame(out, columns=[p.split()[0] for p in PART.split(", ")])

    return run


def _sum_pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("bucket")
    head, parts = rows.iloc[0], rows.iloc[1:]
    n = len(head["doc_ids"])
    score, seen = np.zeros(n), np.zeros(n, np.int64)
    for d, s, h in zip(parts["docs"], parts["score"], parts["seen"]):
        some = np.frombuffer(d, np.uint16)
        score[some] += np.frombuffer(s)
        seen[some] += np.frombuffer(h, np.int32)
    return pd.DataFrame({"doc_id": head["doc_ids"], "n_tokens": head["n_tokens"], "n_seen": seen, "score": score})


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model_path: str | None = None, backoff: float = BACKOFF
) -> DataFrame:
    """One row per document: its id, n_tokens, n_seen (pairs found elsewhere), score and mean_score."""
    path = model_path or default_model()
    packed = stage(packs(docs, doc_id, text, path, bucket_count(docs)), "lm-packs")
    n_packs = packed.filter("bucket = -1").count()
    table = stage(pair_counts(packed, n_packs), "lm-counts")
    copies = max(1, -(-n_packs // JOIN_PACKS))
    copy = F.pmod(F.xxhash64("pack"), F.lit(copies)).alias("copy")
    payload = packed.filter("bucket >= 0").select("pack", "bucket", copy, "pairs", "users", "docs", "uses")
    copied = table.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    joined = payload.join(broadcast_if_small(copied, MAX_BUCKETS, BROADCAST_BYTES), ["bucket", "copy"])
    score_parts = _score_parts(piece_counts(packed), backoff)
    with wide_rows(docs.sparkSession):
        parts = stage(joined.mapInPandas(score_parts, PART), "lm-parts")
    empty = F.lit(None).cast("binary")
    heads = packed.filter("bucket = -1").select(
        "pack", "bucket", empty.alias("docs"), empty.alias("score"), empty.alias("seen"), "doc_ids", "n_tokens"
    )
    scored = parts.unionByName(heads).groupBy("pack").applyInPandas(
        _sum_pack, "doc_id string, n_tokens long, n_seen long, score double"
    )
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("score") / F.col("n_tokens"), 6))
    return scored.select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "n_tokens", "n_seen",
        F.round("score", 6).alias("score"), mean.alias("mean_score"),
    )
