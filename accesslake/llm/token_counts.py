"""Token counts by a Viterbi pass that carries a score and a count and builds no pieces.

The vocabulary and scores are those of a public piece model, read as a unigram model: an Aho-Corasick
automaton lists the pieces that end at each position, and each position keeps the best score of its
prefix and the number of pieces on that path. Rules of the tokenizer: of equal scores the longest last
piece wins; a character that is no piece scores ten below the worst piece and counts as its UTF-8 bytes.

A null or empty text has no tokens. Every row, repeated or without an id, gets its own count; work is
linear in the length of a text, and other columns are not touched.
"""

from functools import lru_cache

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.pieces import Memo, Vocabulary, default_model, segments
from accesslake.llm.texts import per_text, with_result

UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")


class UnigramCounter:
    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.chars = frozenset(vocabulary.pieces[i] for i in vocabulary.normal if len(vocabulary.pieces[i]) == 1)
        self.automaton = ahocorasick.Automaton()
        for i in vocabulary.normal:
            self.automaton.add_word(vocabulary.pieces[i], (len(vocabulary.pieces[i]), vocabulary.scores[i]))
        self.automaton.make_automaton()

    def count(self, part: str) -> tuple[int, float]:
        """Pieces and score of the best path through a segment; matches come longest first."""
        size = len(part)
        best, pieces = [NEVER] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        done = 0

        def close(upto: int) -> None:
            """Unknown characters between the positions that are settled and the next match."""
            for at in range(done, upto):
                if part[at] not in self.chars:
                    score = best[at] + self.unknown
                    if score > best[at + 1]:
                        best[at + 1], pieces[at + 1] = score, pieces[at] + len(part[at].encode())

        for end, (length, score) in self.automaton.iter(part):
            end += 1
            if end - 1 > done:
                close(end - 1)
                done = end - 1
            start = end - length
            score += best[start]
            if score > best[end]:
                best[end], pieces[end] = score, pieces[start] + 1
        close(size)
        return pieces[size], best[size]


@lru_cache(maxsize=2)
def counter(path: str) -> Memo:
    return Memo(UnigramCounter(path).count)


def token_count(text: Column, model_path: str | None = None) -> Column:
    """Struct of n_tokens and best_score, the sum of the chosen pieces' scores."""
    path = model_path or default_model()

    def make():
        memo = counter(path)

        def work(t: str) -> tuple:
            found = [memo[part] for part in segments(t)]
            return sum([n for n, _ in found]), float(sum([s for _, s in found]))

        return work

    return per_text("n_tokens long, best_score double", make)(text)


def count_tokens(docs: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """Documents with a struct column ``counted``, or ``counted_`` beside one of that name."""
    return with_result(docs, "counted", token_count(F.col(text), model_path))
