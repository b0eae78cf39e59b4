"""Token counts of a unigram vocabulary: Viterbi that carries only score and count.

The vocabulary is that of a public model file.  Its scores are merge ranks, so a unigram
model is read from it by a fixed rule: piece of rank r scores ``-log2(r + 2)``, rounded to
eighths.  Sums of eighths are exact in single precision below 2**21, so chunk results add
up to exactly what the tokenizer's single-precision lattice finds; a text whose sum goes
beyond that is walked as one lattice in single precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from compdict.llm.common import held, ship, slices
from compdict.llm.pieces import CACHE, CACHE_CHARS, SPACE, Vocabulary

EXACT_EIGHTHS = 1 << 24
# What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


def rank_eighths(rank: int) -> int:
    return -round(8 * math.log2(rank + 2))


class Counter:
    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.eighths = {p: rank_eighths(i) for p, i in self.v.id.items()}
        self.unknown = min(self.eighths.values()) - round(8 * UNKNOWN_PENALTY)
        self._chunks: dict[str, tuple[int, int]] = {}
        for p, s in self.eighths.items():
            self.v.matches.add_word(p, (len(p), s))
        self.v.matches.make_automaton()

    def walk(self, text: str, add=lambda a, b: a + b, zero=0, unit=lambda s: s):
        """Best score and its piece count.

        The matches that end at a place are tried longest first and replaced only by a better
        one, so of equal scores the longest last piece stands, as in the tokenizer.
        """
        n = len(text)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.v.matches.iter(text):
            ending[end].append(match)
        score, count = [zero] * (n + 1), [0] * (n + 1)
        for e in range(n):
            best, pieces, single = None, 0, False
            for length, s in sorted(ending[e], reverse=True) if len(ending[e]) > 1 else ending[e]:
                total = add(score[e + 1 - length], unit(s))
                if best is None or total > best:
                    best, pieces = total, count[e + 1 - length] + 1
                single |= length == 1
            if not single:
                total = add(score[e], unit(self.unknown))
                if best is None or total > best:
                    best, pieces = total, count[e] + len(text[e].encode())
            score[e + 1], count[e + 1] = best, pieces
        return score[n], count[n]

    def _chunk(self, chunk: str) -> tuple[int, int]:
        made = self.walk(chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self._chunks) >= CACHE:
                self._chunks.clear()
            self._chunks[chunk] = made
        return made

    def count(self, text: str) -> tuple[int, float]:
        """Pieces of the text and the score of the best path."""
        get, new = self._chunks.get, self._chunk
        both = [get(c) or new(c) for c in self.v.chunks(text)]
        score = sum(b[0] for b in both)
        if -score < EXACT_EIGHTHS:
            return sum(b[1] for b in both), score / 8
        single, pieces = self.walk(
            SPACE + text.replace(" ", SPACE), lambda a, b: np.float32(a + b), np.float32(0), lambda s: np.float32(s / 8)
        )
        return pieces, float(single)


def counter(path: str) -> Counter:
    """One counter a worker process and model."""
    return held(("counter", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_tokens, score)`` of every whole text.

    A null or empty text has no tokens and score 0.  Repeated rows and null IDs give a row
    each; other columns are not carried; no row moves between tasks.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        c = counter(model)
        for batch in slices(batches):
            made = [c.count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0] for m in made], pa.int64()), pa.array([float(m[1]) for m in made], pa.float64())],
                names=[id_column, "n_tokens", "score"],
            )

    return ship(docs).select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_tokens bigint, score double")
