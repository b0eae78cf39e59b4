"""Which components are current, which changed, and how a run went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict.functions import clean

# --- fixed values: release states of a withdrawn component ------------------
OBSOLETE_STATES = ("OBS", "WDRN")
STATUSES = ("failed", "compound", "obsolete", "current")
CHANGES = ("new", "updated", "unchanged")


def is_obsolete(replaced_by, release_status) -> Column:
    """Replaced by another component, or released as withdrawn."""
    return F.col(replaced_by).isNotNull() | F.coalesce(
        F.upper(clean.strip(release_status)).isin(*OBSOLETE_STATES), F.lit(False)
    )


def is_compound(subcomponents) -> Column:
    """Made of other components."""
    return F.col(subcomponents).isNotNull()


def is_undated(has_atoms: Column, created: Column, modified: Column) -> Column:
    """Has atoms but neither date, which is an error whatever the order of the tags."""
    return F.coalesce(has_atoms, F.lit(False)) & created.isNull() & modified.isNull()


def status(error: Column, compound: Column, obsolete: Column) -> Column:
    """One word per component: a failure beats compound beats obsolete beats current."""
    return F.when(error, "failed").when(compound, "compound").when(obsolete, "obsolete").otherwise("current")


def header(facts: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """``(doc, block, created, modified, obsolete, compound, error)`` per document.

    ``facts`` has a row per document with its raw header values and parse errors;
    ``failed`` names further documents that count as errors.
    """
    out = facts.withColumn("bad", F.lit(False))
    if failed is not None:
        out = facts.join(failed.select("doc", F.lit(True).alias("bad")).distinct(), "doc", "left")
    out = out.withColumn("created", clean.parse_date("initial")).withColumn("modified", clean.parse_date("modified"))
    return out.select(
        "doc", "block", "created", "modified",
        is_obsolete("replaced_by", "release_status").alias("obsolete"),
        is_compound("subcomponents").alias("compound"),
        (
            (F.size("reasons") > 0)
            | is_undated(F.col("has_atoms"), F.col("created"), F.col("modified"))
            | F.coalesce("bad", F.lit(False))
        ).alias("error"),
    )


def is_changed(created: Column, modified: Column, old_created: Column, old_modified: Column) -> Column:
    """Whether the file is newer than the stored row; a missing stored date counts as older."""
    return (
        F.when(modified.isNotNull(), old_modified.isNull() | (modified > old_modified))
        .when(created.isNotNull(), old_created.isNull() | (created > old_created))
        .otherwise(False)
    )


def compare_with_stored(
    scanned: DataFrame, stored: DataFrame, key: str = "id", created: str = "created", modified: str = "modified"
) -> DataFrame:
    """Add ``change`` to every scanned row: new, updated or unchanged; keys match in any case."""
    old = stored.filter(F.col(key).isNotNull()).groupBy(F.upper(key).alias("_key")).agg(
        F.max(created).alias("_created"), F.max(modified).alias("_modified")
    )
    change = (
        F.when(F.col("_key").isNull(), "new")
        .when(is_changed(F.col(created), F.col(modified), F.col("_created"), F.col("_modified")), "updated")
        .otherwise("unchanged")
    )
    return (
        scanned.join(old, F.upper(scanned[key]) == F.col("_key"), "left")
        .withColumn("change", change)
        .drop("_key", "_created", "_modified")
    )


def load_stats(compared: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """One row of counters; ``compared`` has ``status`` and ``change``."""

    def n(cond: Column, name: str) -> Column:
        return F.count(F.when(cond, 1)).alias(name)

    rows = compared.select("status", "change")
    if gone is not None:
        rows = rows.unionByName(gone.select(F.lit("gone").alias("status"), F.lit(None).cast("string").alias("change")))
    current = F.col("status") == "current"
    return rows.agg(
        n(F.col("status") != "gone", "total"),
        *[n(current & (F.col("change") == c), c) for c in CHANGES],
        *[n(F.col("status") == s, s) for s in STATUSES if s != "current"],
        *([n(F.col("status") == "gone", "gone")] if gone is not None else []),
    )
