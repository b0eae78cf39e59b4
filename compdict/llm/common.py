"""Helpers the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from compdict.checkpoints import cut

# Rows of an Arrow batch that are Python objects at the same time.
SLICE_ROWS = 512


def ship(df: DataFrame) -> DataFrame:
    """Let Python workers import this package: the context serves it to them, once.

    Nothing is sent where the workers' module path already names the folder.
    """
    sc = df.sparkSession.sparkContext
    root = Path(__file__).resolve().parents[2]
    known = any(Path(p).resolve() == root for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)
    if not known and not getattr(sc, "_compdict_sent", False):
        # only the driver reads this file
        archive = Path(tempfile.mkdtemp(prefix="compdict-")) / "compdict_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "compdict").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(archive))
        sc._compdict_sent = True
    return df


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the ID as text, modulo; NULL for a null ID."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


_HELD: list = [None, None]


def held(key, make):
    """What ``make`` builds, kept in a worker process until another key is asked for.

    A worker holds one thing at a time, so the caches of operators that run one after the
    other do not add up.
    """
    if _HELD[0] != key:
        _HELD[:] = [None, None]
        _HELD[:] = [key, make()]
    return _HELD[1]


def class_sample(rows: DataFrame, label: str, key: str, per_class: int, max_classes: int = 200) -> tuple[DataFrame, dict]:
    """About ``per_class`` rows of each of the most frequent classes, chosen by a hash of the key.

    Returns the rows and the full count of each class.  Only the class counts (at most
    ``max_classes``) reach the driver; no row moves between tasks.
    """
    counts = {
        r[0]: r[1]
        for r in rows.groupBy(label).count().filter(F.col(label).isNotNull())
        .orderBy(F.desc("count"), label).limit(max_classes).collect()
    }
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(int(min(1.0, per_class / n) * 1_000_000))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000)) < share), counts


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once a row.

    Without the generator the optimizer may copy the expression into every use, also into
    the body of a lambda.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` of every node with an edge: label is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of the
    label, so chains halve.  Rounds end when no label changes; labels are cut every round.
    """
    both = cut(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).filter("u <> v").distinct()
    )
    labels = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        stepped = labels.join(near, "u").select("u", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        jump = labels.select(F.col("u").alias("next"), F.col("label").alias("far"))
        moved = cut(
            stepped.join(jump, "next", "left")
            .select("u", F.least("next", F.coalesce("far", "next")).alias("label"), "old")
        )
        changed = moved.filter("label <> old").limit(1).count()
        labels = moved.select("u", "label")
        if not changed:
            return labels.select(F.col("u").alias("node"), "label")


def slots(df: DataFrame, group: str, order: list[str], groups: int, name: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 in the given order, over all tasks.

    One range shuffle by (group, order); a number is the place in the partition plus the
    rows of the group in earlier partitions.  The broadcast table has at most
    (partitions + ``groups``) rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(group, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = runs.select(
        F.col(group).alias("_group"), "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(firsts.withColumnRenamed("_part", "_p")), (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_p")))
        .withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_p", "_group", "_shift")
    )
