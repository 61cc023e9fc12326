"""Token counts of a unigram vocabulary, without making the tokens.

Method: an Aho-Corasick automaton enumerates all vocabulary matches of a text; a
Viterbi pass carries, for each end, the best score and the number of pieces on the
best path. Ties go as in the tokenizer: a later candidate must be strictly better,
and candidates of one end come by their start, so the longest piece wins. A letter
without a piece of its own costs ten less than the worst piece and counts one piece
for each of its bytes.

No piece holds a space mark behind another character, so best paths never cross the
start of a space run: a text is scored run by run, and a worker keeps the results of
runs that it has seen, up to a fixed number. Scores are sums of whole numbers here,
exact in double precision, so the parts add up to the path over the whole text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import TextFunction, map_texts

# Fixed value: the mark that stands for a space.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Runs whose results a worker keeps; a full store is emptied. It bounds memory only.
KEPT_RUNS = 250_000
KEPT_LENGTH = 48


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file; pieces that stand for controls or bytes match no text and are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in own]


class Counter:
    """Counts the pieces of the best path."""

    def __init__(self, vocabulary: tuple[tuple[str, float], ...]) -> None:
        if any(MARK in piece.lstrip(MARK) for piece, _ in vocabulary):
            raise ValueError("a piece holds a space mark behind another character: runs cannot be scored on their own")
        self.trie = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.runs = re.compile(f"{MARK}*[^{MARK}\n]+|\n|{MARK}+").findall
        if any("\n" in piece for piece, _ in vocabulary):
            self.runs = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known: dict[str, tuple[float, int]] = {}

    def run(self, run: str) -> tuple[float, int]:
        """Best score and piece count of one run."""
        n = len(run)
        score, count, unset = [0.0] * (n + 1), [0] * (n + 1), None
        reached, unknown, at = 1, self.unknown, -1
        best = unset
        single = False
        for end, (length, own) in self.trie.iter(run):
            while at < end:
                if at >= 0:
                    reached = self._close(run, at, score, count, best, single, unknown)
                at, best, single = at + 1, unset, False
            total = score[end + 1 - length] + own
            if best is None or total > best[0]:
                best = (total, count[end + 1 - length] + 1)
            single = single or length == 1
        while at < n:
            if at >= 0:
                reached = self._close(run, at, score, count, best, single, unknown)
            at, best, single = at + 1, unset, False
        result = (score[n], count[n]) if reached else (0.0, 0)
        if n <= KEPT_LENGTH:
            if len(self.known) >= KEPT_RUNS:
                self.known.clear()
            self.known[run] = result
        return result

    @staticmethod
    def _close(run: str, at: int, score: list, count: list, best, single: bool, unknown: float) -> int:
        """Sets the best path that ends behind the letter ``at``."""
        if not single:
            total = score[at] + unknown
            if best is None or total > best[0]:
                best = (total, count[at] + len(run[at].encode("utf-8", "surrogatepass")))
        score[at + 1], count[at + 1] = best
        return 1

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        known, run = self.known.get, self.run
        found = [known(r) or run(r) for r in self.runs(MARK + text.replace(" ", MARK))]
        return sum([f[0] for f in found]), sum([f[1] for f in found])


@lru_cache(maxsize=2)
def counter(vocabulary: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(vocabulary)


def count_tokens(df: DataFrame, vocabulary: str | list[tuple[str, float]], text_col: str = "text",
                 keep: list[str] | None = None, count_col: str = "n_tokens", score_col: str = "score") -> DataFrame:
    """Adds the number of unigram pieces of each whole text, and the score of its best path.

    ``vocabulary`` is a vocabulary file or a list of pieces and scores. A null or
    empty text has no pieces and score zero. No shuffle; the vocabulary that is sent
    to the workers does not grow with the data.
    """
    own = read_pieces(vocabulary) if isinstance(vocabulary, str) else vocabulary
    sent = df.sparkSession.sparkContext.broadcast(tuple(own))

    def make() -> TextFunction:
        one = counter(sent.value)

        def run(texts: list[str]) -> list[pa.Array]:
            found = [one.text(t) for t in texts]
            return [pa.array(np.array([f[1] for f in found], np.int64)), pa.array(np.array([f[0] for f in found], float))]

        return run

    return map_texts(df, text_col, keep or df.columns, f"`{count_col}` long, `{score_col}` double", make)
