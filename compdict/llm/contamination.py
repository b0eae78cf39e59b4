"""Benchmark passages in documents, with DataFrame functions only.

Windows as long as an item are laid where a document shares a word shingle with the
benchmark (a window that shares none cannot be similar).  Distinct windows get a 64-bit
SimHash.  A multi-index over four 16-bit blocks of the items' fingerprints finds every
item within RADIUS bits: two fingerprints that differ in at most RADIUS bits differ in at
most RADIUS // 4 bits in some block, and the index lists all block values that close.
Candidates are verified by the exact weighted Jaccard similarity of their shingle sets.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import ascii_lower, once

SHINGLE = 5
RADIUS, BLOCKS, BLOCK_BITS = 19, 4, 16
# Long integers of the bit table of benchmark shingles: between these, about 128 bits a shingle.
LEAST_LONGS, MOST_LONGS = 1 << 12, 1 << 16


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs between white space; a null text has none."""
    trimmed = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_hash(w: Column, at: Column) -> Column:
    return F.xxhash64(*[w[at + k] for k in range(SHINGLE)])


def shingles(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the array of shingle hashes in text order; empty below five words."""
    with_words = once(df, "_w", words(text))
    made = F.when(
        F.size("_w") >= SHINGLE,
        F.transform(F.sequence(F.lit(0), F.size("_w") - SHINGLE), lambda i: shingle_hash(F.col("_w"), i)),
    ).otherwise(F.array().cast("array<bigint>"))
    return once(with_words, name, made).drop("_w")


def _constants(values: list[int], kind: str) -> Column:
    """A literal array; written as one text, which the optimizer folds."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _in_table(table: Column, longs: int, h: Column) -> Column:
    """Whether both bits of a hash are set; no hash of the benchmark fails."""
    mask = F.lit(longs - 1).cast("bigint")
    first = F.getbit(table[h.bitwiseAND(mask).cast("int")], F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(63)).cast("int"))
    second = F.getbit(table[F.shiftrightunsigned(h, 28).bitwiseAND(mask).cast("int")], F.shiftrightunsigned(h, 50).bitwiseAND(F.lit(63)).cast("int"))
    return (first == 1) & (second == 1)


def bit_table(spark, hashes: DataFrame) -> list[int]:
    """Bit table of the hashes: one OR a long in Spark; its size is bounded by MOST_LONGS."""
    n = hashes.count()
    longs = min(MOST_LONGS, max(LEAST_LONGS, 1 << max(0, 2 * n - 1).bit_length()))
    h, mask = F.col("h"), F.lit(longs - 1).cast("bigint")
    bits = hashes.select(F.explode(F.array(
        F.struct(h.bitwiseAND(mask).cast("int").alias("at"), F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(63)).cast("int").alias("bit")),
        F.struct(F.shiftrightunsigned(h, 28).bitwiseAND(mask).cast("int").alias("at"), F.shiftrightunsigned(h, 50).bitwiseAND(F.lit(63)).cast("int").alias("bit")),
    )).alias("b")).select("b.at", F.expr("shiftleft(1L, b.bit)").alias("one"))
    out = [0] * longs
    for at, value in bits.groupBy("at").agg(F.bit_or("one")).collect():
        out[at] = value
    return out


def fingerprints(sets: DataFrame, key: str, weights: DataFrame, top: Column) -> DataFrame:
    """``(key, fp, weight)`` of shingle sets ``(key, hs)``: SimHash and total weight.

    A shingle outside the benchmark weighs as much as one that a single item has.
    """
    rows = sets.select(key, F.explode(F.array_distinct("hs")).alias("h")).join(weights, "h", "left")
    rows = rows.select(key, F.xxhash64("h", F.lit(7)).alias("m"), F.coalesce("w", top).alias("w"))
    sums = [F.sum(F.when(F.getbit("m", F.lit(i)) == 1, F.col("w")).otherwise(-F.col("w"))).alias(f"b{i}") for i in range(64)]
    fp = F.lit(0).cast("bigint")
    for i in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{i}") > 0, F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return rows.groupBy(key).agg(F.sum("w").alias("weight"), *sums).select(key, fp.alias("fp"), "weight")


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.75, id_column: str = "doc_id",
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, similarity, first_word)``: the best window of each document and item it leaks.

    Weighted Jaccard of the window's and the item's sets of five-word shingles, at least
    ``similarity``; a shingle weighs ``ln(1 + items / items that have it)``.  Ties go to the
    earliest window.  Items and texts that are null, empty or below five words take no part.
    Rows with one ID, repeated or not, count as one document; rows with a null ID as another.
    A document shorter than an item is one window.
    """
    spark = docs.sparkSession
    items = cut(
        shingles(benchmark.select(F.col(item_column).alias("item"), F.col(item_text).alias("_t")), F.col("_t"), "hs")
        .filter(F.size("hs") > 0).select(F.xxhash64("item", "hs").alias("ikey"), "item", "hs").dropDuplicates(["ikey"])
    )
    n_items = items.count()
    postings = items.select("ikey", F.size("hs").alias("long"), F.posexplode("hs").alias("rel", "h"))
    weights = cut(
        postings.groupBy("h").agg(F.count_distinct("ikey").alias("n"))
        .select("h", F.log(1 + F.lit(float(n_items)) / F.col("n")).alias("w"))
    )
    top = F.log(F.lit(1 + float(n_items)))
    table = bit_table(spark, weights)
    longs = len(table)
    bits = _constants(table, "bigint")
    hashed = shingles(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("_t")), F.col("_t"), "hs").drop("_t")
    shared = once(
        hashed.filter(F.size("hs") > 0), "at",
        F.filter(F.transform("hs", lambda h, i: F.when(_in_table(bits, longs, h), i)), lambda i: i.isNotNull()),
    )
    near = cut(shared.filter(F.size("at") > 0).withColumn("row", F.monotonically_increasing_id()))
    hits = near.select("row", F.size("hs").alias("n"), F.explode("at").alias("at"), "hs").select("row", "n", "at", F.col("hs")[F.col("at")].alias("h"))
    starts = (
        hits.join(postings, "h")
        .select("row", F.least("long", "n").alias("long"), F.greatest(F.lit(0), F.least(F.col("at") - F.col("rel"), F.col("n") - F.col("long"))).alias("start"))
        .distinct().groupBy("row").agg(F.collect_list(F.struct("start", "long")).alias("windows"))
    )
    laid = cut(
        near.select("row", "id", "hs").join(starts, "row")
        .select("id", "hs", F.explode("windows").alias("x"))
        .select("id", F.col("x.start").alias("start"), F.slice("hs", F.col("x.start") + 1, F.col("x.long")).alias("hs"))
        .withColumn("wkey", F.xxhash64("hs"))
    )
    windows = cut(laid.groupBy("wkey").agg(F.first("hs").alias("hs")))
    marks = cut(fingerprints(windows, "wkey", weights, top))
    item_marks = cut(fingerprints(items, "ikey", weights, top))
    # all block values within RADIUS // BLOCKS bits of an item's block
    close = [sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), k)]
    index = item_marks.select(
        "ikey", F.col("fp").alias("ifp"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _block(F.col("fp"), i).alias("v")) for i in range(BLOCKS)])).alias("b"),
    ).select("ikey", "ifp", "b.i", "b.v", F.explode(_constants(close, "int")).alias("m")).select("ikey", "ifp", "i", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
    probes = marks.select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _block(F.col("fp"), i).alias("v")) for i in range(BLOCKS)])).alias("b")
    ).select("fp", "b.i", "b.v")
    within = cut(
        probes.join(index, ["i", "v"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
        .select("fp", "ikey").distinct()
    )
    weighed = items.select("ikey", F.explode(F.array_distinct("hs")).alias("h")).join(weights, "h").groupBy("ikey").agg(
        F.collect_list(F.struct("h", "w")).alias("set")
    ).join(item_marks.select("ikey", F.col("weight").alias("iweight")), "ikey")
    both = (
        marks.select("wkey", "fp", "weight").join(within, "fp").join(windows, "wkey").join(weighed, "ikey")
        .withColumn("common", F.aggregate(F.filter("set", lambda s: F.array_contains("hs", s["h"])), F.lit(0.0), lambda a, s: a + s["w"]))
        .withColumn("similarity", F.col("common") / (F.col("weight") + F.col("iweight") - F.col("common")))
        .filter(F.col("similarity") >= similarity - 1e-9).select("wkey", "ikey", "similarity")
    )
    return (
        laid.select("id", "start", "wkey").join(both, "wkey").join(items.select("ikey", "item"), "ikey")
        .groupBy("id", "item").agg(F.max(F.struct("similarity", -F.col("start"))).alias("best"))
        .select(
            F.col("id").alias(id_column), F.col("item").alias(item_column),
            F.round("best.similarity", 9).alias("similarity"), (-F.col("best.col2")).cast("bigint").alias("first_word"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns stay.

    Rows that share the ID of a leaking row go with it; a null ID is an ID here.
    """
    found = leaks(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    gone = found.select(F.col(id_column).alias("_gone")).distinct()
    return docs.join(gone, docs[id_column].eqNullSafe(gone["_gone"]), "left_anti")
