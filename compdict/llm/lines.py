"""Boilerplate lines: how many distinct sites a line spreads over, with DataFrame functions only.

Each line hash gets a HyperLogLog sketch of its sites, merged by aggregation.  Lines whose
estimate is near the threshold get an exact distinct count.  Lines on enough sites leave
every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import once

# Registers of a sketch: 2 ** LOG_K; its relative error is about 1.04 / sqrt(2 ** LOG_K).
LOG_K = 9
ERROR = 1.04 / 2 ** (LOG_K / 2)


def line_array(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def spread_lines(docs: DataFrame, least_sites: int, site_column: str, text_column: str) -> DataFrame:
    """``(line, sites, exact)`` of the hashes of all lines on at least ``least_sites`` sites.

    Blank lines have no hash.  A null site is no site.
    """
    lines = once(docs.select(F.col(site_column).cast("string").alias("site"), F.col(text_column).alias("_t")), "_l", F.array_distinct(line_array(F.col("_t"))))
    lines = (
        lines.select("site", F.explode("_l").alias("l")).filter("trim(l) <> '' AND site IS NOT NULL")
        .select(F.xxhash64("l").alias("line"), "site")
    )
    # lines of one site leave before anything is sketched; both ends of an order say so
    several = lines.groupBy("line").agg(F.min("site").alias("low"), F.max("site").alias("high"), F.hll_sketch_agg("site", LOG_K).alias("sketch"))
    estimated = cut(
        several.filter(F.lit(least_sites <= 1) | (F.col("low") < F.col("high")))
        .select("line", F.hll_sketch_estimate("sketch").alias("estimate"))
        .filter(F.col("estimate") >= least_sites * (1 - 4 * ERROR) - 1)
    )
    near = estimated.filter(F.col("estimate") <= least_sites * (1 + 4 * ERROR) + 1)
    exact = lines.join(near, "line", "left_semi").groupBy("line").agg(F.count_distinct("site").alias("sites"))
    sure = estimated.filter(F.col("estimate") > least_sites * (1 + 4 * ERROR) + 1)
    return exact.filter(F.col("sites") >= least_sites).select("line", "sites", F.lit(True).alias("exact")).unionByName(
        sure.select("line", F.col("estimate").alias("sites"), F.lit(False).alias("exact"))
    )


def remove_spread_lines(
    docs: DataFrame, least_sites: int = 5, id_column: str = "doc_id", site_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """All columns of ``docs``, with ``text`` less the lines that stand on ``least_sites`` sites or more,
    and ``_n_lines``, ``_n_removed``.

    Every occurrence leaves, in every document, repeated rows alike; the other lines keep
    their order.  Null texts stay null (no lines), a text of which no line is left is empty;
    a text without such lines is unchanged to the byte.  Lines are compared exactly, by a
    64-bit hash.  Other columns, whatever their names, are carried.
    """
    spread = cut(spread_lines(docs, least_sites, site_column, text_column).select("line"))
    # The hit lines of a document: by ID, or by the text where the ID is null.  Rows that share an
    # ID share the set, which only holds lines that leave everywhere.
    key = F.when(F.col(id_column).isNotNull(), F.xxhash64(id_column)).otherwise(F.xxhash64(text_column))
    mine = once(docs.select(key.alias("_key"), F.col(text_column).alias("_t")), "_l", F.array_distinct(line_array(F.col("_t"))))
    hit = (
        mine.select("_key", F.explode("_l").alias("l")).filter("trim(l) <> ''")
        .select("_key", F.xxhash64("l").alias("line"))
        .join(spread, "line").groupBy("_key").agg(F.collect_set("line").alias("_gone"))
    )
    with_key = docs.withColumn("_key", F.when(F.col(text_column).isNotNull(), key))
    return (
        once(with_key.join(hit, "_key", "left").drop("_key"), "_lines", line_array(F.col(text_column)))
        .withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(
            F.filter("_lines", lambda l: ~F.array_contains("_gone", F.xxhash64(l)))))
        .withColumn("_n_lines", F.when(F.col(text_column).isNull(), 0).otherwise(F.size("_lines")).cast("bigint"))
        .withColumn("_n_removed", (F.size("_lines") - F.size("_kept")).cast("bigint"))
        .withColumn(text_column, F.when(F.col("_n_removed") > 0, F.array_join("_kept", "\n")).otherwise(F.col(text_column)))
        .drop("_gone", "_lines", "_kept")
    )
