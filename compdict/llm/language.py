"""Language of a text: a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on segments of bytes.  Every byte position
gets class probabilities from the states of both directions; a document's probabilities are
their mean over all its positions.  Gates are piecewise linear (clipped), so a step is a few
array operations over many segments at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.llm.common import class_sample, ship, slices

HIDDEN = 8
STEPS = 64
# Segments that go through the network together.
LANES = 4096
LETTER = re.compile(r"[^\W\d_]")


def segments(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts as rows of STEPS bytes: ``(bytes, valid bytes, text of the row)``."""
    counts = np.array([-(-len(d) // STEPS) for d in data])
    lengths = np.array([len(d) for d in data])
    padded = b"".join([d + bytes(c * STEPS - len(d)) for d, c in zip(data, counts.tolist())])
    x = np.frombuffer(padded, np.uint8).reshape(-1, STEPS)
    owner = np.repeat(np.arange(len(data)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return x, np.minimum(STEPS, lengths[owner] - place * STEPS), owner


def _gate(a):
    return np.clip(a, -2.5, 2.5, out=a)


@dataclass
class Direction:
    """One direction: what a byte adds to the three gates, and the recurrent weights."""

    x: np.ndarray  # 3H x 256
    u: np.ndarray  # 3H x H

    def run(self, bytes_by_step: np.ndarray, order, keep: bool = False):
        """States of all steps (steps x H x lanes); with ``keep`` also what the way back needs."""
        H, n = self.u.shape[1], bytes_by_step.shape[1]
        h = np.zeros((H, n), np.float32)
        states = np.empty((len(bytes_by_step), H, n), np.float32)
        trail = {}
        into = np.empty((3 * H, n), np.float32)
        back = np.empty((3 * H, n), np.float32)
        for t in order:
            np.take(self.x, bytes_by_step[t], axis=1, out=into, mode="clip")
            np.dot(self.u, h, out=back)
            rz = into[: 2 * H] + back[: 2 * H]
            np.clip(rz, -2.5, 2.5, out=rz)
            rz *= 0.2
            rz += 0.5
            r, z = rz[:H], rz[H:]
            c = r * back[2 * H :]
            c += into[2 * H :]
            np.clip(c, -1, 1, out=c)
            if keep:
                trail[t] = (h, rz, c, back[2 * H :].copy(), into[2 * H :] + r * back[2 * H :])
            h = h + z * (c - h)
            states[t] = h
        return (states, trail) if keep else states


@dataclass
class Model:
    classes: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray  # classes x 2H
    bias: np.ndarray
    extra: dict = field(default_factory=dict)

    def segment_sums(self, x: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Sum over a segment's valid positions of the class probabilities (segments x classes)."""
        H, steps = self.ahead.u.shape[1], np.ascontiguousarray(x.T)
        a = self.ahead.run(steps, range(STEPS))
        b = self.behind.run(steps, range(STEPS - 1, -1, -1))
        total = np.zeros((len(self.classes), x.shape[0]), np.float32)
        for t in range(STEPS):
            p = self.out[:, :H] @ a[t] + self.out[:, H:] @ b[t]
            p += self.bias[:, None]
            np.exp(p, out=p)
            p *= (valid > t) / p.sum(0)
            total += p
        return total.T

    def probabilities(self, texts: list[str]) -> np.ndarray:
        data = [t.encode() for t in texts]
        x, valid, owner = segments(data)
        sums = np.zeros((len(texts), len(self.classes)))
        for at in range(0, len(x), LANES):
            part = slice(at, at + LANES)
            np.add.at(sums, owner[part], self.segment_sums(x[part], valid[part]))
        return sums / np.maximum(1, np.array([len(d) for d in data]))[:, None]


def train(rows: list[bytes], label: np.ndarray, classes: list[str], rounds: int = 400, lanes: int = 256, rate: float = 0.01, seed: int = 3) -> Model:
    """Backpropagation through time with Adam; every position of a segment bears its text's label."""
    rng = np.random.default_rng(seed)
    H, C = HIDDEN, len(classes)
    x_all, valid_all, owner = segments(rows)
    y_all = label[owner]
    p = {
        "xa": rng.normal(0, 0.3, (3 * H, 256)), "ua": rng.normal(0, 0.3, (3 * H, H)),
        "xb": rng.normal(0, 0.3, (3 * H, 256)), "ub": rng.normal(0, 0.3, (3 * H, H)),
        "o": rng.normal(0, 0.3, (C, 2 * H)), "b": np.zeros(C),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    for k in "xa", "xb":
        p[k][H : 2 * H] -= 1.0
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    share = np.bincount(y_all, minlength=C)
    chance = (1 / share[y_all]) / (1 / share[y_all]).sum()
    picks = rng.choice(len(x_all), (rounds, min(lanes, len(x_all))), p=chance)
    for k, pick in enumerate(picks, 1):
        steps, valid, y = np.ascontiguousarray(x_all[pick].T), valid_all[pick], y_all[pick]
        n = len(pick)
        ahead, behind = Direction(p["xa"], p["ua"]), Direction(p["xb"], p["ub"])
        a, trail_a = ahead.run(steps, range(STEPS), keep=True)
        b, trail_b = behind.run(steps, range(STEPS - 1, -1, -1), keep=True)
        g = {q: np.zeros_like(v) for q, v in p.items()}
        da, db = np.empty_like(a), np.empty_like(b)
        total = valid.sum()
        for t in range(STEPS):
            both = np.concatenate([a[t], b[t]])
            z = p["o"] @ both + p["b"][:, None]
            z = np.exp(z - z.max(0))
            z /= z.sum(0)
            z[y, np.arange(n)] -= 1
            z *= (valid > t) / total
            g["o"] += z @ both.T
            g["b"] += z.sum(1)
            d = p["o"].T @ z
            da[t], db[t] = d[:H], d[H:]
        _back(steps, range(STEPS - 1, -1, -1), trail_a, da, p["ua"], g["xa"], g["ua"])
        _back(steps, range(STEPS), trail_b, db, p["ub"], g["xb"], g["ub"])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        pace = rate * min(1.0, 1.5 * (1 - k / (rounds + 1)))
        for q in p:
            v = g[q] * min(1.0, 1.0 / (norm + 1e-9))
            m = moments[q]
            m[0] = 0.9 * m[0] + 0.1 * v
            m[1] = 0.999 * m[1] + 0.001 * v * v
            p[q] -= (pace * (m[0] / (1 - 0.9**k)) / (np.sqrt(m[1] / (1 - 0.999**k)) + 1e-8)).astype(np.float32)
    return Model(classes, Direction(p["xa"], p["ua"]), Direction(p["xb"], p["ub"]), p["o"], p["b"])


def _back(steps, order, trail, dh_out, u, gx, gu) -> None:
    """One direction's way back; adds to the gradients of the byte table and the recurrent weights."""
    H, n = u.shape[1], steps.shape[1]
    dh = np.zeros((H, n), np.float32)
    for t in order:
        h, rz, c, back, raw = trail[t]
        dh = dh + dh_out[t]
        r, z = rz[:H], rz[H:]
        dc = dh * z * (np.abs(raw) < 1)
        open_gate = (rz > 0) & (rz < 1)
        drz = np.concatenate([dc * back, dh * (c - h)]) * open_gate * 0.2
        into = np.concatenate([drz, dc])
        rec = np.concatenate([drz, dc * r])
        for j in range(3 * H):
            gx[j] += np.bincount(steps[t], into[j], 256)
        gu += rec @ h.T
        dh = dh * (1 - z) + u.T @ rec


def fit(docs: DataFrame, per_class: int = 300, longest: int = 4096, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", **options) -> Model:
    """Fit on a bounded sample: about ``per_class`` texts of each of at most 200 languages, chosen by
    hash of the ID; of a sampled text at most ``longest`` characters are used for training.

    Rows without text or language take no part.  Without any such row the model knows no language.
    """
    rows = docs.filter(F.col(label_column).isNotNull() & (F.length(text_column) > 0))
    chosen, _ = class_sample(rows, label_column, id_column, per_class)
    got = sorted(
        (r[0], r[1], r[2])
        for r in chosen.select(label_column, id_column, F.substring(text_column, 1, longest)).collect()
    )
    classes = sorted({r[0] for r in got})
    if not got:
        return Model([], Direction(np.zeros((24, 256)), np.zeros((24, 8))), Direction(np.zeros((24, 256)), np.zeros((24, 8))), np.zeros((0, 16)), np.zeros(0))
    where = {c: i for i, c in enumerate(classes)}
    return train([r[2].encode() for r in got], np.array([where[r[0]] for r in got]), classes, **options)


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (the ID by default), ``lang_pred`` and ``score`` (its pooled probability) of every whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no
    language was learned.  Ties go to the first language in alphabetical order.  Repeated rows
    give equal results; no row moves between tasks.
    """
    kept = keep or [id_column]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size for each language

    def run(batches):
        m = sent.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(len(kept)).to_pylist()]
            spoken = [i for i, t in enumerate(texts) if LETTER.search(t)] if m.classes else []
            name, value = ["und"] * len(texts), [0.0] * len(texts)
            if spoken:
                p = m.probabilities([texts[i] for i in spoken])
                for i, best, top in zip(spoken, p.argmax(1).tolist(), p.max(1).tolist()):
                    name[i], value[i] = m.classes[best], min(1.0, max(0.0, top))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(name, pa.string()), pa.array(value, pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return ship(docs).select(*kept, F.col(text_column).alias("_said")).mapInArrow(run, f"{fields}, lang_pred string, score double")
