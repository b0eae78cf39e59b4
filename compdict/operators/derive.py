"""Facts about a parent derived from its child rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: what counts as an aromatic bond flag ---------------------
AROMATIC = ("Y", "YES")


@dataclass(frozen=True)
class Fact:
    """An aggregate over child rows, the value for a parent without any, and what to keep.

    ``only_positive`` leaves the old value when the aggregate is not above zero.
    """

    value: Column
    default: object = None
    only_positive: bool = False


def row_count() -> Fact:
    return Fact(F.count(F.lit(1)).cast("int"), 0)


def count_not_equal(column: str, value: str) -> Fact:
    """Rows whose column differs from a value; a NULL is not counted."""
    return Fact(F.count(F.when(F.col(column) != value, 1)).cast("int"), 0)


def any_flag(column: str, values=AROMATIC) -> Fact:
    """yes when any row carries one of the flags, else no."""
    hit = F.bool_or(F.coalesce(F.upper(column).isin(*[v.upper() for v in values]), F.lit(False)))
    return Fact(F.when(hit, "yes").otherwise("no"), "no")


def exact_flag(column: str, value: str = "yes") -> Fact:
    """yes when any row carries exactly the value, else no."""
    return Fact(F.when(F.bool_or(F.coalesce(F.col(column) == value, F.lit(False))), "yes").otherwise("no"), "no")


def smallest(column: str, where: Column) -> Fact:
    """Smallest non-null value of the rows that meet a condition, by code points."""
    return Fact(F.min(F.when(where, F.col(column))))


def derive(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    facts: dict[str, Fact],
    overwrite: bool = False,
) -> DataFrame:
    """Add or fill parent columns from one aggregation over the child rows.

    The aggregation is combined before its shuffle, so a parent with a third of all
    child rows arrives as one row per map task.  An existing column is filled where it
    is NULL; with ``overwrite`` it is set.
    """
    agg = (
        children.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(*[f.value.alias(f"_fact_{c}") for c, f in facts.items()])
    )
    joined = parents.join(agg, F.col(parent_key) == F.col("_key"), "left")
    filled = {}
    for c, fact in facts.items():
        new = F.col(f"_fact_{c}")
        if fact.default is not None:
            new = F.coalesce(new, F.lit(fact.default))
        if c in parents.columns and not overwrite:
            new = F.coalesce(F.col(c), new)
        elif c in parents.columns and fact.only_positive:
            new = F.when(new > 0, new).otherwise(F.col(c))
        filled[c] = new
    return joined.withColumns(filled).drop("_key", *[f"_fact_{c}" for c in facts])


def backfill(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, columns: dict[str, str]
) -> DataFrame:
    """Fill NULL child columns from the parent row; the parent key is unique.

    Child rows are the streamed side, so a hot parent is split by the skew-join rule.
    """
    side = parents.select(F.col(parent_key).alias("_key"), *[F.col(p).alias(f"_from_{c}") for c, p in columns.items()])
    joined = children.join(side, F.col(child_key) == F.col("_key"), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_from_{c}")) for c in columns}).drop(
        "_key", *[f"_from_{c}" for c in columns]
    )
