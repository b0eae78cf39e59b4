"""Replacing, removing and adding components together with their child rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict.functions import clean


def hashed(keys: DataFrame, *by: str) -> DataFrame:
    """``keys`` as the hashed side of a join: a task holds its keys, and the other side streams by unsorted.

    With the columns ``by`` they are joined on, the shuffle's partitions stay as they are dealt: put
    together to a size in bytes, one task may get to hash millions of short keys.
    """
    if by:
        keys = keys.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
    return keys.hint("shuffle_hash")


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys; combined on the map side, so a hot key is one row per task."""
    return hashed(df.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct())


def _norm(key: str, any_case: bool) -> Column:
    return F.upper(key) if any_case else F.col(key)


def only_in(df: DataFrame, keys: DataFrame, key: str, any_case: bool = False) -> DataFrame:
    """Rows whose key is among ``keys._key``."""
    return df.join(keys, _norm(key, any_case) == keys["_key"], "left_semi")


def not_in(df: DataFrame, keys: DataFrame, key: str, any_case: bool = False) -> DataFrame:
    """Rows whose key is not among ``keys._key``; a null key stays."""
    return df.join(keys, _norm(key, any_case) == keys["_key"], "left_anti")


def new_only(source: DataFrame, target: DataFrame, key: str, target_key: str) -> DataFrame:
    """Source rows whose component the target does not hold yet; null keys never pass."""
    return not_in(source.filter(F.col(key).isNotNull()), keys_of(target, target_key), key)


def replace_components(old: DataFrame, new: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Old rows of unchanged components plus new rows of changed ones.

    ``changed._key`` holds upper-cased keys of components that loaded without error, so a
    failed component keeps all its old rows and gains none.
    """
    return not_in(old, changed, key, any_case=True).unionByName(only_in(new, changed, key, any_case=True))


def gone_keys(stored: DataFrame, scanned: DataFrame, stored_key: str, scanned_key: str) -> DataFrame:
    """``_key`` of stored components no longer among the scanned ones (upper-cased)."""
    have = stored.select(F.upper(stored_key).alias("_key")).filter("_key IS NOT NULL").distinct()
    seen = scanned.select(F.upper(scanned_key).alias("_key")).filter("_key IS NOT NULL").distinct()
    return have.join(seen, "_key", "left_anti")


class TooManyGone(ValueError):
    """More components would be removed than a run may remove."""


def guard_gone(gone: DataFrame, stored: DataFrame, stored_key: str, max_gone_fraction: float) -> None:
    """Fail when a run would remove too large a share, as after scanning an empty folder."""
    n_gone = gone.count()
    n_stored = keys_of(stored, stored_key).count()
    if n_gone > max_gone_fraction * n_stored:
        raise TooManyGone(f"{n_gone} of {n_stored} components are gone")


def remove_components(tables: dict[str, DataFrame], gone: DataFrame, keys: dict[str, str]) -> dict[str, DataFrame]:
    """Every table without the rows of the gone components."""
    return {name: not_in(df, gone, keys[name], any_case=True) for name, df in tables.items()}


def cascade(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent survives; a child without a key has no parent to lose."""
    keys = parent.select(F.col(parent_key).alias("_key")).filter("_key IS NOT NULL")
    return only_in(child, hashed(keys, "_key"), child_key).unionByName(child.filter(F.col(child_key).isNull()))


def fill_nulls(df: DataFrame, sources: dict[str, str | Column]) -> DataFrame:
    """Fill NULLs of a column from another column of the same row; values are kept."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(s) if isinstance(s, str) else s) for c, s in sources.items()})


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Put the column default where a value is missing."""
    return fill_nulls(df, {c: F.lit(v) for c, v in defaults.items() if c in df.columns})


def complete(df: DataFrame, layout) -> DataFrame:
    """The columns of a layout in its order and types; columns the input lacks are NULL."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in layout.fields:
        source = have.get(field.name.lower())
        col = F.lit(None) if source is None else F.col(source)
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def refresh_action(
    upstream: DataFrame,
    local: DataFrame,
    key: str = "id",
    created: str = "created",
    modified: str = "modified",
) -> DataFrame:
    """What to do with each upstream component given local edits.

    ``(key, action, upstream_modified, local_modified)``; action is NEW (not held locally),
    REPLACE (newer upstream, never edited locally), CONFLICT (newer upstream, edited
    locally) or UNCHANGED.  A missing date counts as 1970-01-01.
    """
    up = upstream.select(
        F.col(key),
        clean.epoch_if_null(created).alias("_up_created"),
        clean.epoch_if_null(modified).alias("_up_modified"),
    )
    here = local.select(
        F.col(key).alias("_here"),
        clean.epoch_if_null(created).alias("_created"),
        clean.epoch_if_null(modified).alias("_modified"),
    )
    newer = (F.col("_up_created") > F.col("_modified")) | (F.col("_up_modified") > F.col("_modified"))
    action = (
        F.when(F.col("_here").isNull(), "NEW")
        .when(newer & (F.col("_created") == F.col("_modified")), "REPLACE")
        .when(newer, "CONFLICT")
        .otherwise("UNCHANGED")
    )
    return up.join(here, F.col(key) == F.col("_here"), "left").select(
        key, action.alias("action"),
        F.col("_up_modified").alias("upstream_modified"), F.col("_modified").alias("local_modified"),
    )


def refresh_stats(actions: DataFrame) -> DataFrame:
    """One row: total, new, updated (replaced or in conflict), conflicts."""
    a = F.col("action")
    return actions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(a == "NEW", 1)).alias("new"),
        F.count(F.when(a.isin("REPLACE", "CONFLICT"), 1)).alias("updated"),
        F.count(F.when(a == "CONFLICT", 1)).alias("conflicts"),
    )


def remove_along(
    tables: dict[str, DataFrame], references, root: str, root_key: str, gone: DataFrame
) -> dict[str, DataFrame]:
    """Every table without the rows of the gone components and without every row that refers to a
    removed row, walking ``references`` level by level from ``root``.

    ``references`` are ``(child, child columns, parent, parent columns)``.  A child row leaves
    when its columns equal the key columns of a removed row of a parent (compared as text in
    any case); its own keys then go on to the tables that refer to it.  Only distinct keys move
    from one level to the next, made distinct before their shuffle.  A null reference removes
    nothing; tables the walk does not reach stay as they are.  Without the root table, edges
    from it use the gone keys as its removed keys.
    """
    edges = []
    for e in references:
        # a reference named twice removes the same rows
        if e[0] in tables and (e[2] in tables or e[2] == root) and e[0] != root and e not in edges:
            edges.append(e)
    gone = hashed(gone)
    if root in tables:
        removed = {root: only_in(tables[root], gone, root_key, any_case=True)}
        out = {root: not_in(tables[root], gone, root_key, any_case=True)}
    else:
        # without the root table its removed rows are known by their keys only
        removed, out = {root: gone.select(F.col("_key").alias(root_key))}, {}
    pending = {e[0] for e in edges}
    while pending:
        ready = sorted(t for t in pending if all(e[2] in removed for e in edges if e[0] == t))
        if not ready:
            raise ValueError(f"references form a cycle among {sorted(pending)}")
        for table in ready:
            kept, hits = tables[table], []
            for child, columns, parent, parent_columns in edges:
                if child != table:
                    continue
                keys = hashed(removed[parent].select(
                    *[F.upper(F.col(c).cast("string")).alias(f"_k{i}") for i, c in enumerate(parent_columns)]
                ).distinct())
                same = reduce(lambda a, b: a & b, [F.upper(F.col(c).cast("string")) == keys[f"_k{i}"] for i, c in enumerate(columns)])
                hits.append(tables[table].join(keys, same, "left_semi"))
                kept = kept.join(keys, same, "left_anti")
            removed[table] = reduce(DataFrame.unionByName, hits)
            out[table] = kept
            pending.discard(table)
    return {name: out.get(name, df) for name, df in tables.items()}
