"""Token counts of a unigram vocabulary without building tokens: count-only Viterbi over Aho-Corasick matches.

All pieces that end at a position are enumerated by one automaton. The best score of each prefix is kept with its number
of pieces, so no path is stored. Ties and unknown characters follow the tokenizers library: a later candidate for a
position wins only with a larger score, pieces come before it by earlier start, an unknown character costs 10 below the
smallest score, and unknown neighbours are one token. Byte pieces are left out, so there is no byte fallback, and
words part at every mark, so pieces that are runs of marks never match.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from collections.abc import Iterator
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read_table, small_batches, utf8

PIECES = "piece_bpe_32k.model"
UNKNOWN = "<unk>"
MARK = "▁"
#: counts of distinct words kept by a task
CACHE = 200_000
UNKNOWN_PENALTY = 10.0
MAX_PIECES = 2_000_000


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """``(piece, score)`` of a sentencepiece file; control pieces are left out, the unknown piece is first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECES))
    known = [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(UNKNOWN, 0.0), *known]


class Counter(dict):
    """Word -> ``(tokens, begins with unknown, ends with unknown)`` is cached as tokens of the word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            if p:
                self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = n
        return n

    def count(self, word: str) -> int:
        """Tokens of one word with its mark."""
        n = len(word)
        ends: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(word):
            ends[end].append(found)
        score, tokens, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(1, n + 1):
            best, single = None, False
            for size, s in sorted(ends[e - 1], reverse=True):
                single |= size == 1
                total = score[e - size] + s
                if best is None or total > best:
                    best, tokens[e], unknown[e] = total, tokens[e - size] + 1, False
            if not single:
                total = score[e - 1] + self.unknown
                if best is None or total > best:
                    best, unknown[e] = total, True
                    tokens[e] = tokens[e - 1] + (not unknown[e - 1])
            score[e] = best
        return tokens[n]

    def text(self, text: str) -> int:
        """Tokens of a text: each space becomes a mark that begins a word, and so does the text's start."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        words = marked.split(MARK)
        get = self.__getitem__
        total = sum(get(MARK + w) for w in words[1:])
        return total + (get(words[0]) if words[0] else 0)


def token_counts(
    docs: DataFrame, pieces: list[tuple[str, float]] | None = None, text: str = "text", into: str = "n_tokens"
) -> DataFrame:
    """Add the number of tokens of every text; none for a null or empty text. Texts are counted whole."""
    pieces = pieces or vocabulary()
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} pieces; at most {MAX_PIECES} are sent to the tasks")
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(sent.value)
        for texts in batches:
            found = utf8(pa.array(texts, pa.string(), from_pandas=True))
            yield pd.Series(np.array([counter.text(t.decode()) for t in found], np.int64))

    return small_batches(docs).withColumn(into, count(F.col(text).cast("string")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")
