"""Row numbers and surrogate IDs without a one-task window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.operators import merge


def number_rows(
    df: DataFrame, order_by: list[str], name: str = "id", start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number all rows in key order: ``row_number() OVER (ORDER BY ...)`` over all tasks.

    One range shuffle puts the rows in order; a row's number is its place in its
    partition plus the sizes of the partitions before it.  Places are fixed by a
    checkpoint, so a lost executor cannot move a border.  Rows with equal keys are
    spread by a random tie breaker and take any order among themselves.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order_by, "_tie"]
    placed = cut(
        df.withColumn("_tie", F.rand(11))
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_tie")
    )
    run = F.shiftright("_at", 33)
    sizes = placed.groupBy(run.alias("_run")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range partition
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_run", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_first"))
    return (
        placed.withColumn("_run", run)
        .join(F.broadcast(firsts), "_run")
        .withColumn(name, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_run", "_first", "_at")
    )


def number_within(df: DataFrame, group: list[str], order_by: list[str], name: str = "id") -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY ...)``, also for groups too large for a task.

    All rows are numbered in ``(group, order)`` order over all tasks and each group's first
    number is taken off.
    """
    numbered = number_rows(df, [*group, *order_by], "_all")
    firsts = numbered.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(F.min("_all").alias("_low"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    return (
        numbered.join(firsts, same)
        .withColumn(name, (F.col("_all") - F.col("_low") + 1).cast("int"))
        .drop("_all", "_low", *[f"_g_{g}" for g in group])
    )


def surrogate_ids(df: DataFrame, key: str, name: str, start: int, hashed: bool = False) -> DataFrame:
    """Give rows with a unique key consecutive IDs in key order, from ``start``.

    Only the keys are sorted and written; the rows join back on them, on request unsorted
    (``merge.hashed``).
    """
    ids = number_rows(df.select(F.col(key).alias("_key")), ["_key"], "_id", start)
    if hashed:
        ids = merge.hashed(ids, "_key")
    rest = df.drop(name) if name in df.columns else df
    return rest.join(ids, F.col(key) == F.col("_key")).withColumn(name, F.col("_id").cast("int")).drop("_key", "_id")


def next_id(*columns: tuple[DataFrame, str]) -> int:
    """First free ID of a sequence that several tables share."""
    top = 0
    for df, column in columns:
        top = max(top, df.agg(F.max(column)).first()[0] or 0)
    return top + 1
