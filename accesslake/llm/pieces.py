"""SentencePiece BPE over a public vocabulary: encoding by a table of last pieces, and decoding.

The encoding of every prefix of a text ends in one piece that no other choice can replace. An
Aho-Corasick automaton lists the pieces that end at each position; the one that may stand after the
last piece of the shorter prefix is stored, and the ids are then read off from the end backwards.
Two pieces may stand side by side if undoing their merges, latest first, never uncovers a pair that
would have been joined earlier.

Empty and null texts have no ids and decode to an empty text; a text may be of any length, as work and
memory are linear in it. Characters outside the vocabulary become their UTF-8 bytes. Rows with any
ids, repeated ones and those with other columns keep their place: each row is encoded by itself.
"""

import hashlib
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import per_text, with_result

SPACE = "▁"
#: Bounds of what a worker remembers: segments of up to so many characters, twice some 15 MB, and pairs of pieces, some 30 MB.
CACHED_SEGMENTS = 80_000
CACHED_PAIRS = 500_000
LONGEST_CACHED = 64


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def segments(text: str) -> list[str]:
    """Parts of a text that no piece spans, each without the first of the spaces it starts with.

    A space is put before the text, as the model does; pieces hold spaces only at their start.
    """
    if not text:
        return []
    words = text.replace(SPACE, " ").split(" ")
    if "" not in words:
        return words
    parts, pad = [], 0
    for word in words:
        if word:
            parts.append(SPACE * pad + word)
            pad = 0
        else:
            pad += 1
    if pad:
        parts.append(SPACE * (pad - 1))
    return parts


class Memo(dict):
    """Results by segment; when there are too many, those that were not used since the last time are forgotten. Long segments are not kept."""

    def __init__(self, work):
        super().__init__()
        self.work = work
        self.before = {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.work(SPACE + key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= CACHED_SEGMENTS:
                self.before = self.copy()
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.scores = [model.get_score(i) for i in ids]
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.normal = [i for i in ids if i not in special]
        of_byte = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.raw = [of_byte.get(i, b"" if i in special else self.pieces[i].replace(SPACE, " ").encode()) for i in ids]
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in self.normal):
            raise ValueError("the vocabulary has pieces with a space after other characters")


class BytePairs:
    """Encoder and decoder of one model.

    Inside, pieces are numbered with single characters first and merges after them in their order.
    """

    def __init__(self, path: str):
        vocabulary = self.vocabulary = Vocabulary(path)
        chars = [i for i in vocabulary.normal if len(vocabulary.pieces[i]) == 1]
        merges = [i for i in vocabulary.normal if len(vocabulary.pieces[i]) > 1]
        merges.sort(key=lambda i: (-vocabulary.scores[i], i))
        self.n_chars = len(chars)
        self.id_of = chars + merges
        number = {vocabulary.pieces[i]: n for n, i in enumerate(chars)}
        self.chars = frozenset(number)
        self.halves: list[tuple[int, int]] = [(n, n) for n in range(self.n_chars)]
        self.joined: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        for n, i in enumerate(merges, self.n_chars):
            piece = vocabulary.pieces[i]
            splits = ((number.get(piece[:k]), number.get(piece[k:])) for k in range(1, len(piece)))
            own = next((s for s in splits if None not in s and self.side_by_side(*s)), None)
            self.halves.append(own or (n, n))
            if own:  # a piece that its own text never merges into is never used
                self.joined[own] = n
                number[piece] = n
        self.pairs.clear()
        self.automaton = ahocorasick.Automaton()
        for piece, n in number.items():
            self.automaton.add_word(piece, (len(piece), n))
        self.automaton.make_automaton()

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether no merge across the border of two pieces comes before one that formed them."""
        limit = len(self.id_of) + 1
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                if left < self.n_chars:
                    return True
                limit, left = left, self.halves[left][1]
            else:
                if right < self.n_chars:
                    return True
                limit, right = right + 1, self.halves[right][0]

    def encode_part(self, part: str) -> bytes:
        """Ids, two bytes each, of a segment with its spaces."""
        size = len(part)
        last: list[tuple[int, int] | None] = [None] * (size + 1)
        pairs = self.pairs
        for end, match in self.automaton.iter(part):
            end += 1
            if last[end] is not None:
                continue
            length, piece = match
            start = end - length
            if start:
                before = last[start]
                if before is None:  # a character outside the vocabulary ends there
                    if part[start - 1] in self.chars:
                        continue
                else:
                    key = before[1] << 16 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= CACHED_PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self.side_by_side(before[1], piece)
                    if not fits:
                        continue
            last[end] = match
        ids, at, id_of, of_byte = array("H"), size, self.id_of, self.vocabulary.bytes
        while at:
            match = last[at]
            if match is None:
                ids.extend([of_byte[b] for b in reversed(part[at - 1].encode())])
                at -= 1
            else:
                ids.append(id_of[match[1]])
                at -= match[0]
        ids.reverse()
        return ids.tobytes()

    def decode(self, ids) -> bytes:
        """UTF-8 text of ids; the space before the text is taken off again."""
        raw = self.vocabulary.raw
        text = b"".join([raw[i] for i in ids])
        return text[1:] if text[:1] == b" " else text


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> tuple[BytePairs, Memo]:
    """The model of a worker process and its memo of segments."""
    model = BytePairs(path)
    if len(model.vocabulary.pieces) > 1 << 16:
        raise ValueError("ids do not fit two bytes")
    return model, Memo(model.encode_part)


def encode_text(memo: Memo, text: str) -> np.ndarray:
    return np.frombuffer(b"".join(map(memo.__getitem__, segments(text))), np.uint16)


def encoding(text: Column, model_path: str | None = None, with_ids: bool = False) -> Column:
    """Struct of n_tokens, ids_sha256, decoded_sha256 and, on request, the ids themselves."""
    path = model_path or default_model()
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def make():
        model, memo = byte_pairs(path)
        decimal = [str(i) for i in range(len(model.vocabulary.pieces))]

        def work(t: str) -> tuple:
            packed = encode_text(memo, t)
            ids = packed.tolist()
            listed = ",".join([decimal[i] for i in ids])
            row = len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(model.decode(ids)).hexdigest()
            return (*row, packed.astype(np.int32)) if with_ids else row

        return work

    return per_text(schema, make)(text)


def encode_documents(docs: DataFrame, text: str = "text", model_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents with a struct column ``encoded``, or ``encoded_`` beside one of that name; every row stays and is encoded whole."""
    return with_result(docs, "encoded", encoding(F.col(text), model_path, with_ids))


def decode_documents(encoded: DataFrame, ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """Adds ``decoded``, or ``decoded_`` beside one of that name: the text of an array of ids; null ids decode to null."""
    path = model_path or default_model()

    @F.pandas_udf("string")
    def texts(column):
        model, _ = byte_pairs(path)
        return column.map(lambda x: None if x is None else model.decode(x).decode("utf-8", "replace"))

    return with_result(encoded, "decoded", texts(F.col(ids)))
