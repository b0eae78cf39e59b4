"""Approximate nearest neighbours by inner product: shifted space-filling curves.

Each curve projects the vectors by its own random rotation, shifts them, and orders them by
their Hilbert key.  Spark sorts every curve by range; a vector's rank on the curve gives its
window.  Queries meet the rows of their own and the two neighbouring windows on every curve;
the windows' best rows merge and are ranked by the exact inner product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import ship, slots

DIMS, KEY_BITS = 12, 5
CURVES = 32
# A window holds at least so many rows, and at least this share of all.
LEAST_WINDOW, WINDOW_SHARE = 512, 0.01


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (rows x dimensions, below 2 ** bits), by the
    exclusive-or form of the transform: undo excess rotations from the top bit down, then
    Gray-encode, then interleave."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (((v ^ turn) >> b) & 1)
    return key


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, v)`` of the rows that take part: an ID, and a vector that is not zero, without a null
    or non-finite component, of the commonest length (the shorter one of equals)."""
    v = F.col(vector_column)
    rows = vectors.select(F.col(id_column).alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    first = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (first[0] if first else 0))


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, curves: int = CURVES, least_window: int = LEAST_WINDOW,
    share: float = WINDOW_SHARE, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 11,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row of ``queries``.

    Nearness is the largest inner product in double precision, ties to the smaller ID; a
    query's own ID is no candidate.  Rows that ``usable`` leaves out take no part on either
    side.  Of equal vectors the ``k + 1`` smallest IDs stand for all: no query can need more.
    Repeated rows count once.  Vectors of unequal norm get one more coordinate, so that the
    largest inner product is the nearest neighbour (zero for unit vectors).

    The window is ``share`` of the rows, as recall at a fixed window falls when the table
    grows unless the data have few real dimensions; see the README for measured recall.
    """
    rows = usable(ship(vectors), id_column, vector_column).dropDuplicates(["id", "v"])
    same = Window.partitionBy("v").orderBy("id")
    rows = cut(rows.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k + 1).drop("_copy"))
    asked = cut(usable(queries, id_column, vector_column).dropDuplicates(["id", "v"]))
    n = rows.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    size = len(rows.first()["v"])
    norms = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    top = rows.agg(F.max(norms)).first()[0]
    rng = np.random.default_rng(seed)
    dims = min(DIMS, size + 1)
    turns = np.stack([np.linalg.qr(rng.normal(size=(size + 1, size + 1)))[0][:, :dims] for _ in range(curves)])
    shifts = rng.random((curves, dims))
    # an extent for each projected dimension: three deviations, from one pass
    spread = 3 * np.sqrt(top / max(1, size))

    def keyed(batches, is_query: bool):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(batch.column(1).to_pylist(), np.float64)
            extra = np.zeros(len(v)) if is_query else np.sqrt(np.maximum(0, top - (v * v).sum(1)))
            full = np.concatenate([v, extra[:, None]], 1)
            for c in range(curves):
                place = (full @ turns[c] / spread + 1) / 2 * 0.5 + shifts[c] * 0.5
                cells = np.clip((place * (1 << KEY_BITS)).astype(np.int64), 0, (1 << KEY_BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([is_query] * len(v)), pa.array([c] * len(v), pa.int32()), pa.array(hilbert(cells, KEY_BITS))],
                    names=["id", "v", "asks", "curve", "key"],
                )

    kind = dict(rows.dtypes)["v"]
    out = f"id bigint, v {kind}, asks boolean, curve int, key bigint"
    placed = rows.mapInArrow(lambda b: keyed(b, False), out).unionByName(asked.mapInArrow(lambda b: keyed(b, True), out))
    ranked = slots(placed, "curve", ["key", "id"], curves, "at")
    window = max(least_window, -(-int(n * share * 1000) // 1000))
    ranked = ranked.withColumn("w", F.floor(F.col("at") / window))
    near = ranked.withColumn(
        "w", F.explode(F.when(F.col("asks"), F.array(F.col("w") - 1, F.col("w"), F.col("w") + 1)).otherwise(F.array("w")))
    )

    def best(rows: pa.Table) -> pa.Table:
        asks = np.array(rows.column("asks"))
        ids, v = np.array(rows.column("id")), rows.column("v")
        made = ([], [], [])
        if asks.any() and not asks.all():
            q = np.array(v.filter(pa.array(asks)).to_pylist(), np.float64)
            c = np.array(v.filter(pa.array(~asks)).to_pylist(), np.float64)
            qi, ci = ids[asks], ids[~asks]
            order = np.argsort(ci, kind="stable")
            c, ci = c[order], ci[order]
            for at in range(0, len(q), 256):
                # one sum for each pair of vectors, in the same order in every window
                s = np.einsum("qd,cd->qc", q[at : at + 256], c)
                s[qi[at : at + 256][:, None] == ci[None]] = -np.inf
                pick = np.argsort(-s, axis=1, kind="stable")[:, :k]
                score = np.take_along_axis(s, pick, 1)
                ok = np.isfinite(score)
                made[0].append(np.repeat(qi[at : at + 256], pick.shape[1])[ok.ravel()])
                made[1].append(ci[pick][ok])
                made[2].append(score[ok])
        flat = [np.concatenate(m) if m else np.empty(0, t) for m, t in zip(made, (np.int64, np.int64, np.float64))]
        return pa.table({"query_id": flat[0], "vec_id": flat[1], "score": flat[2]})

    found = near.groupBy("curve", "w").applyInArrow(best, "query_id bigint, vec_id bigint, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
