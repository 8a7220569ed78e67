"""Operator 4, token counts by a count-only Viterbi search.

An Aho-Corasick automaton enumerates every match of a unigram vocabulary; dynamic programming over
the end positions carries the best score and the number of pieces only, never the pieces. The tie
rules are those of the tokenizers library's Unigram model: starts in order, matches of a start from
short to long, a later path wins only if its score is strictly larger; a character that no
one-character piece covers may be unknown (the lowest score less 10); runs of unknown characters
fuse, and count one piece, or one per byte where the vocabulary has the byte pieces.

Texts are cut at blanks as the library's Metaspace pre-tokenizer does, so each distinct word is
searched once per worker (a bounded cache). No shuffle.

Defined results: null and empty texts have 0 tokens; repeated rows repeat; other columns are not
read, so they cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers, each shorter than CACHE_LENGTH.
CACHE_WORDS, CACHE_LENGTH = 500_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; byte_fallback: unknown characters become their bytes."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = True


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece file, whatever it was trained for, as unigrams."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((sp.id_to_piece(k), sp.get_score(k)) for k in range(sp.get_piece_size())))


class _Words(dict):
    """Pieces of each word without its blank, searched when first asked for."""

    def __init__(self, search):
        self.search = search

    def __missing__(self, word: str) -> int:
        found = self.search(BLANK + word)
        if len(word) < CACHE_LENGTH and len(self) < CACHE_WORDS:  # frequent words come early and stay
            self[word] = found
        return found


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.scores = dict(vocabulary.pieces)
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, value in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), value))
        self.automaton.make_automaton()
        self.cache = _Words(self._search)

    def _search(self, word: str) -> int:
        """The automaton yields ends in order and, at one end, starts in order: the order of the tie rules."""
        n = len(word)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        unknown: set[int] = set()

        def close(end: int) -> None:
            """Without a one-character piece the last character may be unknown; it comes last in order."""
            reached = best[end - 1] + self.unknown
            if reached > best[end]:
                size = len(word[end - 1].encode()) if self.byte_fallback else int(end - 1 not in unknown)
                best[end], count[end] = reached, count[end - 1] + size
                unknown.add(end)

        closing, single = 0, True
        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            if end != closing:
                if not single:
                    close(closing)
                for gap in range(closing + 1, end):
                    close(gap)
                closing, single = end, False
            reached = best[end - length] + value
            if reached > best[end]:
                best[end], count[end] = reached, count[end - length] + 1
            if length == 1:
                single = True
        if not single:
            close(closing)
        for gap in range(closing + 1, n + 1):
            close(gap)
        return count[n]

    def text(self, text: str) -> int:
        """Tokens of a text: a blank is put before it, and each word starts at its blank."""
        if not text:
            return 0
        if not text.startswith((" ", BLANK)):
            text = " " + text
        if BLANK in text:
            text = text.replace(BLANK, " ")
        return sum(map(self.cache.__getitem__, text.split(" ")[1:]))


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    """One automaton and cache for each Python worker, kept over its tasks."""
    return Counter(piece_vocabulary(path))


def token_counts(df: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens): tokens of each whole text."""

    def run(batches):
        counter = _counter(vocabulary_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([counter.text(t.as_py()) for t in batch.column(1)], pa.int64())], names=["key", "n_tokens"])

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, n_tokens long").withColumnRenamed("key", key)
