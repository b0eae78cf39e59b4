"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (hashed into buckets), so a
misspelling shares most of its vector with the word it stands for.  A window of words is the
mean of its words, a linear softmax scores the window, and a document is as toxic as its
windows are under a smooth maximum, so a few words in a long text are not averaged away.
Embeddings and softmax are trained jointly in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.llm.common import class_sample, held, ship, slices

GRAMS = (3, 5)
BUCKETS = 1 << 16
DIMENSIONS = 4
WINDOW, STRIDE = 16, 8
# Words a worker keeps the scalar of, up to this many characters each; a full cache is emptied.
CACHE, CACHED_LENGTH = 250_000, 200


# N-grams in fewer sampled documents than this keep a zero vector.
LEAST_DOCUMENTS = 20
# Sentence punctuation between words; other marks may stand inside a disguised word.
PUNCTUATION = str.maketrans(dict.fromkeys('.,;:!?"()', " "))


def words(text: str) -> list[str]:
    return text.lower().translate(PUNCTUATION).split()


def grams(word: str) -> Iterator[int]:
    """Buckets of all the word's n-grams, from its first character to its last, and of the word itself."""
    whole, crc = f"<{word}>".encode(), zlib.crc32
    for n in GRAMS:
        for i in range(len(whole) - n + 1):
            yield crc(whole[i : i + n]) & BUCKETS - 1
    yield crc(whole) & BUCKETS - 1


def gram_count(word: str) -> int:
    size = len(word.encode()) + 2
    return sum(max(0, size - n + 1) for n in GRAMS) + 1


def window_means(values: np.ndarray) -> np.ndarray:
    """Means of all windows of a document's word values; the last window ends at the last word."""
    n = len(values)
    if n <= WINDOW:
        return np.array([values.mean() if n else 0.0])
    starts = np.arange(0, n - WINDOW, STRIDE)
    starts = np.append(starts, n - WINDOW)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[starts + WINDOW] - total[starts]) / WINDOW


def smooth_max(scores: np.ndarray) -> float:
    top = scores.max()
    return float(top + np.log(np.exp(scores - top).mean())) if top < 30 else float(top)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dimensions
    weights: np.ndarray  # dimensions x 2
    bias: np.ndarray  # 2

    def __post_init__(self):
        # softmax of two classes: only the difference of their logits counts
        self.by_gram = self.vectors @ (self.weights[:, 1] - self.weights[:, 0])
        self.shift = float(self.bias[1] - self.bias[0])
        self._start({})

    def _start(self, cache: dict[str, float]) -> None:
        self._cache, self._list = cache, self.by_gram.tolist()

    def word(self, w: str) -> float:
        if len(self._cache) >= CACHE:
            self._cache.clear()
        value = sum(map(self._list.__getitem__, grams(w))) / gram_count(w)
        if len(w) <= CACHED_LENGTH:
            self._cache[w] = value
        return value

    def score(self, text: str) -> float:
        get, new = self._cache.get, self.word
        ws = words(text)
        found = [get(w) for w in ws]
        if None in found:
            found = [new(w) if v is None else v for w, v in zip(ws, found)]
        z = smooth_max(window_means(np.array(found)) + self.shift)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def train(texts: list[str], toxic: list[int], weight: np.ndarray, rounds: int = 100, rate: float = 0.2, seed: int = 5) -> Model:
    """Full-batch Adam over all windows of the given documents, starting from small random vectors."""
    rng = np.random.default_rng(seed)
    y = np.asarray(toxic, float)
    known: dict[str, int] = {}
    stream, doc_of, start, end, doc = [], [], [], [], []
    base = 0
    for d, t in enumerate(texts):
        ids = [known.setdefault(w, len(known)) for w in words(t)] or [known.setdefault("", len(known))]
        stream += ids
        n = len(ids)
        doc_of += [d] * n
        starts = [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]
        start += [base + s for s in starts]
        end += [base + min(n, s + WINDOW) for s in starts]
        doc += [d] * len(starts)
        base += n
    stream, doc_of, start, end, doc = map(np.asarray, (stream, doc_of, start, end, doc))
    size = (end - start).astype(float)
    per_doc = np.bincount(doc, minlength=len(texts)).astype(float)
    of = [np.fromiter(grams(w), np.int64, gram_count(w)) for w in known]
    lengths = np.array([len(g) for g in of])
    flat, owner = np.concatenate(of), np.repeat(np.arange(len(of)), lengths)
    seen = np.zeros(BUCKETS, np.int64)
    for ids in np.split(stream, np.cumsum(np.bincount(doc_of, minlength=len(texts)))[:-1]):
        seen[np.unique(np.concatenate([of[i] for i in np.unique(ids)]))] += 1
    common = seen >= LEAST_DOCUMENTS
    flat, owner = flat[common[flat]], owner[common[flat]]
    E = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)) * common[:, None]
    W, b = rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    b[1] = np.log((weight * y).sum() / (weight * (1 - y)).sum())
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (E, W, b)]
    edge = np.flatnonzero(np.diff(doc, prepend=-1))
    for k in range(1, rounds + 1):
        # forward: gram -> word -> window -> document
        vec = np.stack([np.bincount(owner, E[flat, j], len(known)) for j in range(DIMENSIONS)], 1) / lengths[:, None]
        w = W[:, 1] - W[:, 0]
        s = (vec @ w)[stream]
        total = np.concatenate(([0.0], np.cumsum(s)))
        l = (total[end] - total[start]) / size
        top = np.maximum.reduceat(l, edge)
        e = np.exp(l - top[doc])
        mass = np.add.reduceat(e, edge)
        z = top + np.log(mass / per_doc) + b[1] - b[0]
        p = 1 / (1 + np.exp(-z))
        dz = weight * (p - y) / weight.sum()
        # backward
        dl = dz[doc] * e / mass[doc] / size
        step = np.bincount(start, dl, base + 1) - np.bincount(end, dl, base + 1)
        dword = np.bincount(stream, np.cumsum(step)[:base], len(known))
        dW = vec.T @ dword
        dgram = np.bincount(flat, (dword / lengths)[owner], BUCKETS)
        grads = (
            np.outer(dgram, w) + 1e-6 * E,
            np.stack([-dW, dW], 1) + 1e-5 * W,
            np.array([-dz.sum(), dz.sum()]),
        )
        for param, g, m in zip((E, W, b), grads, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            param -= rate * min(1.0, k / 10) * (m[0] / (1 - 0.9**k)) / (np.sqrt(m[1] / (1 - 0.999**k)) + 1e-8)
    return Model(E, W, b)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 20_000, **options) -> Model:
    """Fit on a bounded sample: about ``per_class`` documents of each class, chosen by hash of
    the ID, of texts up to ``longest`` characters (2 * 1,500 * 20,000 characters at most, 10 MB
    typically).  ``labels`` holds ``doc_id, toxic``; rows with another label than 0 or 1, and
    labels without a document, take no part.  Each class counts as often as in all labels.
    """
    marked = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen, counts = class_sample(marked, "toxic", "doc_id", per_class)
    if set(counts) != {0, 1}:
        return Model(np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.array([0.0, 1.0 if 1 in counts else -1.0]))
    # the chosen labels are bounded by per_class
    rows = sorted(
        docs.select("doc_id", F.col("text").alias("_text")).filter(F.length("_text") <= longest)
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "_text").collect()
    )
    y = np.array([r[1] for r in rows], np.int64)
    n = np.bincount(y, minlength=2)
    weight = np.array([counts[0], counts[1]])[y] / np.maximum(n, 1)[y]
    if n.min() == 0:
        return Model(np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.array([0.0, 1.0 if n[1] else -1.0]))
    return train([r[2] for r in rows], y.tolist(), weight, **options)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (the ID by default), ``score`` and ``predicted`` of every whole text, in the task that reads it.

    A null text scores like an empty one, that is by the bias alone.  Repeated rows give equal
    scores.  The model (a table of buckets, of fixed size) travels with the task.
    """
    kept = keep or [id_column]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    table, shift = model.by_gram.astype(np.float32), model.shift
    sent = docs.sparkSession.sparkContext.broadcast((table, shift))

    def run(batches):
        grams_table, bias = sent.value
        m = Model.__new__(Model)
        m.by_gram, m.shift = grams_table, bias
        m._start(held(("toxicity", zlib.crc32(grams_table.tobytes())), dict))
        for batch in slices(batches):
            s = [m.score(t or "") for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())],
                names=[*kept, "score", "predicted"],
            )

    return ship(docs).select(*kept, F.col(text_column).alias("_scored")).mapInArrow(run, f"{fields}, score double, predicted int")
