"""Piece encoding, token counts and language-model scores against libraries and brute force."""

import hashlib
import math
import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from accesslake.llm import lm, pieces, token_counts  # noqa: E402
from accesslake.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
FIXED = [
    "", " ", "  ", " a", "a ", "a  b   c ", "\n", "▁x ▁", "日本語 テキスト", "😀😀 a😀b", "aaaaaaa", "<s> </s> <0x0A>", "\x00a\x01", "x" * 500,
    " " * 40 + "def f():\n" + " " * 8 + "return 1", "�", "ﬁ ½ Å", "é" * 30,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def some_texts():
    rnd = random.Random(5)
    return FIXED + ["".join(rnd.choice("abcde  theion\n.,1é日😀▁") for _ in range(rnd.randint(0, 60))) for _ in range(400)]


def test_encoding_equals_library(spark, texts, library):
    found = some_texts()
    rows = pieces.encode_documents(texts(*found), with_ids=True).select("doc_id", "encoded.*").collect()
    for r in rows:
        ids = library.encode(found[r.doc_id])
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    again = pieces.decode_documents(pieces.encode_documents(texts(*found), with_ids=True).select("doc_id", "encoded.ids"))
    assert {r.doc_id: r.decoded for r in again.collect()} == {i: library.decode(library.encode(t)) for i, t in enumerate(found)}


def test_encoding_query_equals_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op8_sentencepiece"](spark, SF).collect():
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, library.encode(docs[r.doc_id]))).encode()).hexdigest()


def unigram_library():
    tokenizers = pytest.importorskip("tokenizers")
    v = pieces.Vocabulary(pieces.default_model())
    reachable = set(v.normal) | set(v.bytes) | {0}
    vocab = [(p if i in reachable else f"\x01special{i}", s) for i, (p, s) in enumerate(zip(v.pieces, v.scores))]
    return tokenizers.Tokenizer(tokenizers.models.Unigram(vocab=vocab, unk_id=0, byte_fallback=True))


def test_counts_equal_unigram_library(spark, texts):
    found, library = some_texts(), unigram_library()
    rows = token_counts.count_tokens(texts(*found)).select("doc_id", "counted.*").collect()
    for r in rows:
        t = found[r.doc_id]
        assert r.n_tokens == (len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0)


def test_odd_rows(odd, none, odd_rows):
    for frame in (pieces.encode_documents(odd), token_counts.count_tokens(odd)):
        assert frame.count() == len(odd_rows)
    by_text = {r.text: r.counted.n_tokens for r in token_counts.count_tokens(odd).select("text", "counted").collect()}
    assert by_text[None] == by_text[""] == 0
    assert pieces.encode_documents(none).count() == token_counts.count_tokens(none).count() == lm.score_documents(none).count() == 0


def brute_scores(docs, library):
    ids = [(i, library.encode(t or "")) for i, t in docs]
    pairs, firsts, own, total = Counter(), Counter(), Counter(), 0
    for _, x in ids:
        before = [1, *x[:-1]] if x else []
        pairs.update(zip(before, x)), firsts.update(before), own.update(x)
        total += len(x)
    out = []
    for i, x in ids:
        mine = Counter(zip([1, *x[:-1]], x)) if x else Counter()
        score = seen = 0
        for (u, v), n in mine.items():
            rest = pairs[u, v] - n
            seen += n * (rest > 0)
            score += n * (math.log(rest / firsts[u]) if rest > 0 else math.log(0.4 * own[v] / total))
        out.append((i, len(x), seen, round(score, 3)))
    return sorted(out, key=str)


def test_scores_equal_brute_force(spark, odd, library, monkeypatch):
    for name, value in (("PACK_TOKENS", 20_000), ("FAN_IN", 2), ("JOIN_PACKS", 2)):
        monkeypatch.setattr(lm, name, value)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for frame in (docs, odd):
        got = [(r.doc_id, r.n_tokens, r.n_seen, round(r.score, 3)) for r in lm.score_documents(frame).collect()]
        want = brute_scores([(r.doc_id, r.text) for r in frame.collect()], library)
        got = sorted(got, key=str)
        assert [x[:3] for x in got] == [x[:3] for x in want]
        assert all(abs(a[3] - b[3]) < 0.01 + 1e-7 * abs(b[3]) for a, b in zip(got, want))


def test_frequent_segments_are_remembered(monkeypatch):
    """A segment that is used again and again is worked out once, however many others pass by, and memory stays bounded."""
    monkeypatch.setattr(pieces, "CACHED_SEGMENTS", 100)
    calls = Counter()
    memo = pieces.Memo(lambda part: calls.update([part]) or part.encode())
    for i in range(1000):
        assert memo["often"] == "▁often".encode() and memo[f"once{i}"] == f"▁once{i}".encode()
        assert len(memo) + len(memo.before) <= 200
    assert calls["▁often"] == 1 and memo["x" * 100] and "x" * 100 not in memo
