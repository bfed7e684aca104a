"""Token counts by a count-only Viterbi over Aho-Corasick matches.

An automaton of the unigram vocabulary enumerates every piece that ends at each position, longest
first; the best score and its number of pieces are carried along, nothing else. Equal scores keep
the piece that starts first, and characters without a piece count as their bytes, so that counts
equal those of the encoder. Scores are whole numbers (see ``unigram``) and add up exactly over the
units between positions that no piece crosses; results of recent units are remembered.

Edge cases: null and empty texts count 0 tokens and score 0; repeated rows are counted each.
"""

from __future__ import annotations

import functools

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from tierlake.llm.common import annotate, prepare, read_table, texts_of
from tierlake.llm.unigram import NEVER, VOCABULARY, Remembered, Vocabulary, automaton, load, normalised

#: A unit's score and count in one whole number, so that one sum adds both.
_SHIFT = 40


def best_count(matcher: ahocorasick.Automaton, unknown: int, unit: str) -> tuple[int, int]:
    """Score of the best segmentation and the number of its tokens."""
    best, count = [0], [0]
    matches = iter(matcher.iter(unit))
    end, found = next(matches, (-1, None))
    for at, letter in enumerate(unit):
        score, pieces, own = NEVER, 0, False
        while end == at:
            length, worth, _ = found
            start = at + 1 - length
            if best[start] + worth > score:
                score, pieces = best[start] + worth, count[start] + 1
            own |= length == 1
            end, found = next(matches, (-1, None))
        if not own and best[at] + unknown > score:
            score, pieces = best[at] + unknown, count[at] + len(letter.encode("utf-8", "replace"))
        best.append(score)
        count.append(pieces)
    return best[-1], count[-1]


class UnitCounts(Remembered):
    def __init__(self, vocabulary: Vocabulary):
        matcher, unknown = automaton(vocabulary), vocabulary.unknown

        def packed(unit: str) -> int:
            score, count = best_count(matcher, unknown, unit)
            return (score << _SHIFT) + count

        super().__init__(packed)


class _Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.units: UnitCounts | None = None

    def __call__(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if self.units is None:
            self.units = UnitCounts(self.vocabulary)
        split = self.vocabulary.units.findall
        sums = [sum(map(self.units.__getitem__, split(normalised(t)))) if t else 0 for t in texts_of(batch)]
        return {
            "n_tokens": pa.array(np.array([s & ((1 << _SHIFT) - 1) for s in sums], dtype=np.int64)),
            "score": pa.array(np.array([s >> _SHIFT for s in sums], dtype=np.int64)),
        }

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "units": None}


def count_tokens(documents: DataFrame, vocabulary: Vocabulary, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents plus ``n_tokens`` and ``score``, the best segmentation's score."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.LongType())]
    return annotate(documents, fields, _Counter(vocabulary), drop)


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return load(path)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(documents, _vocabulary(VOCABULARY), drop=("text",))
