"""Shards by a k-d tree over the texts' metadata.

Each node of the tree holds a number of shards.  A node of more than one is split at the
weighted quantile of its widest metadata dimension, weight being the bytes of a row, so both
sides get bytes in proportion to their shards.  All nodes of a level are split together.
The quantile is found by digits: an aggregation sums the bytes of each node by the next
digit of the sort key, the driver picks the digit of the border (at most 2,048 sums a node),
until what is left on the border is too light to matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import slots

# A key is three parts of 33 bits: the dimension, the text, the row.
DIGIT, DIGITS = 11, 3
# Rows of one text stay together if they are lighter than this part of a shard.
TOGETHER = 0.02
# A border stops being refined at this part of a shard.
LIGHT = 0.001
DIMENSIONS = ("chars", "extra", "lines")


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Size, checksum and metadata of every whole text: characters, bytes beyond one a character, lines."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    size = F.octet_length(text).cast("bigint")
    chars = F.char_length(text).cast("bigint")
    return docs.select(
        F.col(id_column).alias("id"),
        (size + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        chars.alias("chars"), (size - chars).alias("extra"),
        (chars - F.char_length(F.translate(text, "\n", ""))).cast("bigint").alias("lines"),
        F.pmod(F.xxhash64(text), F.lit(1 << 33)).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )


def split_levels(rows: DataFrame, shards: int) -> DataFrame:
    """Give every row a ``shard``; ``rows`` has ``size``, the dimensions, ``_text`` and ``_row``."""
    spark = rows.sparkSession
    rows = rows.withColumn("_last", F.pmod(F.xxhash64("id", "_row"), F.lit(1 << 33)))
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaf = total / shards
    nodes = {0: (0, shards)}  # node: (first shard, number of shards)
    placed = cut(rows.withColumn("node", F.lit(0)))
    while any(n > 1 for _, n in nodes.values()):
        open_nodes = {k: v for k, v in nodes.items() if v[1] > 1}
        ranges = {
            r["node"]: r
            for r in placed.filter(F.col("node").isin(*open_nodes)).groupBy("node").agg(
                F.sum("size").alias("size"), *[F.min(d).alias(f"low_{d}") for d in DIMENSIONS],
                *[F.max(d).alias(f"high_{d}") for d in DIMENSIONS],
            ).collect()
        }
        whole = {d: max([1, *(r[f"high_{d}"] for r in ranges.values())]) for d in DIMENSIONS}
        state = {}
        for k, (_, n) in open_nodes.items():
            if k in ranges:
                r = ranges[k]
                wide = max(DIMENSIONS, key=lambda d: (r[f"high_{d}"] - r[f"low_{d}"]) / whole[d])
                state[k] = {"dim": DIMENSIONS.index(wide), "need": r["size"] * (n // 2) / n}
        bits = max(max(whole.values()).bit_length(), 1)
        _find_borders(spark, placed, state, leaf, DIGITS - -(-bits // DIGIT))
        params = spark.createDataFrame(
            [(k, s["dim"], *s["border"]) for k, s in state.items()],
            "node int, dim int, b0 bigint, b1 bigint, b2 bigint",
        ) if state else None
        new, moves = {}, []
        for k, (first, n) in nodes.items():
            if n == 1:
                new[2 * k + 2] = (first, 1)
                continue
            new[2 * k + 1], new[2 * k + 2] = (first, n // 2), (first + n // 2, n - n // 2)
        if params is None:
            nodes = new
            continue
        left = F.struct(_dimension(), F.col("_text"), F.col("_last")) < F.struct("b0", "b1", "b2")
        placed = cut(
            placed.join(F.broadcast(params), "node", "left")
            .withColumn("node", F.when(F.col("dim").isNotNull() & left, 2 * F.col("node") + 1).otherwise(2 * F.col("node") + 2))
            .drop("dim", "b0", "b1", "b2")
        )
        nodes = new
    leaves = spark.createDataFrame([(k, v[0]) for k, v in nodes.items()], "node int, shard int")
    return placed.join(F.broadcast(leaves), "node").drop("node", "_last")


def _dimension():
    return reduce(lambda rest, i: F.when(F.col("dim") == i, F.col(DIMENSIONS[i])).otherwise(rest), range(len(DIMENSIONS)), F.lit(0).cast("bigint"))


def _find_borders(spark, placed: DataFrame, state: dict, leaf: float, first: int) -> None:
    """Set ``border`` of every node: rows with a smaller key go left.  A digit of all nodes a round.

    What a round looks for stands in columns, so the compiled code of one round serves all.
    """
    for s in state.values():
        s["prefix"] = [0] * first
    for level in range(first, 3 * DIGITS):
        going = {k: s for k, s in state.items() if "border" not in s}
        if not going:
            return
        part, digit = divmod(level, DIGITS)
        shift = DIGIT * (DIGITS - 1 - digit)
        bounds = spark.createDataFrame(
            [(k, s["dim"], part, shift, *(e := _parts(s["prefix"]))[:2], e[part] >> (shift + DIGIT)) for k, s in going.items()],
            "node int, dim int, part int, shift int, e0 bigint, e1 bigint, cur bigint",
        )
        value = F.when(F.col("part") == 0, _dimension()).when(F.col("part") == 1, F.col("_text")).otherwise(F.col("_last"))
        rows = placed.join(F.broadcast(bounds), "node").withColumn("value", value).filter(
            ((F.col("part") < 1) | (_dimension() == F.col("e0"))) & ((F.col("part") < 2) | (F.col("_text") == F.col("e1")))
            & (F.call_function("shiftright", F.col("value"), F.col("shift") + DIGIT) == F.col("cur"))
        )
        digit_of = F.call_function("shiftright", F.col("value"), F.col("shift")).bitwiseAND(F.lit((1 << DIGIT) - 1))
        sums: dict[int, list] = {k: [] for k in going}
        for k, *bin_ in rows.groupBy("node", digit_of.alias("digit")).agg(
            F.sum("size"), F.count(F.lit(1)), (F.min("_text") == F.max("_text"))
        ).collect():
            sums[k].append(bin_)
        for k, s in going.items():
            at, weight, last = 0, 0, True
            for at, weight, n, one_text in sorted(sums[k]):
                last = n == 1 or weight <= LIGHT * leaf or (one_text and weight <= TOGETHER * leaf)
                if s["need"] < weight:
                    break
                s["need"] -= weight
            else:
                at, weight, last = at + 1, 0, True
            # what the border falls into is not cut further: it goes to the side it is nearer to
            if last or level == 3 * DIGITS - 1:
                s["border"] = _parts([*s["prefix"], at + int(s["need"] > weight / 2)])
            else:
                s["prefix"] = [*s["prefix"], at]


def _parts(prefix: list[int]) -> list[int]:
    out = []
    for p in range(3):
        value = 0
        for i in range(DIGITS):
            at = p * DIGITS + i
            value = (value << DIGIT) + (prefix[at] if at < len(prefix) else 0)
        out.append(value)
    return out


def shard(docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the ID, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    The law is ``bytes``: shards are near equal in bytes, to about a row on each border.
    Equal texts have equal keys and stay together unless a border falls into a group heavier
    than ``TOGETHER`` of a shard, which is then cut by a hash of the row.  A null text counts
    as empty (size 8, checksum 0).  Repeated rows and null IDs are rows like others.  Slots
    number a shard's rows from 0 by ID and row.  An empty table gives no rows.
    """
    rows = cut(measured(docs, id_column, text_column))
    placed = split_levels(rows, shards)
    numbered = slots(placed.select("id", "size", "text_crc32", "shard", "_row"), "shard", ["id", "_row"], shards)
    return numbered.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", "slot")
