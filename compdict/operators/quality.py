"""Checks that stand in for keys, references and not-null rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compdict.functions import clean


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys..., n)`` of keys held by more than one row; a key with a NULL is never a duplicate."""
    full = df.dropna(subset=keys)
    return full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def reference_violations(
    child: DataFrame, references: dict[str, tuple[str, ...]], parent: DataFrame, parent_columns: tuple[str, ...]
) -> DataFrame:
    """``(reference, key_1.., n)`` of child references no parent row answers.

    All references of a child to one parent are stacked and counted per key, a column a
    reference, before the one anti join: the counts are combined before their shuffle, which
    deals them by the key as the join needs them.  A reference with a NULL in it is not checked.
    """
    names = [f"key_{i + 1}" for i in range(len(parent_columns))]
    stacked = child.select(
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("_ref"), *[F.col(c).alias(n) for c, n in zip(cols, names)])
            for i, cols in enumerate(references.values())
        ])).alias("r")
    ).select("r.*").dropna(subset=names)
    counted = stacked.groupBy(*names).agg(*[F.count(F.when(F.col("_ref") == i, 1)).alias(f"_n{i}") for i in range(len(references))])
    known = parent.select(*[F.col(c).alias(n) for c, n in zip(parent_columns, names)]).dropna().distinct()
    return counted.join(known, names, "left_anti").select(
        *names,
        F.explode(F.array(*[F.struct(F.lit(ref).alias("reference"), F.col(f"_n{i}").alias("n")) for i, ref in enumerate(references)])).alias("r"),
    ).select("r.reference", *names, "r.n").filter("n > 0")


def not_null_violations(df: DataFrame, columns, keep: list[str]) -> DataFrame:
    """``(keep..., column)``: one row per NULL in a column that must have a value."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))
    return df.select(*keep, F.explode(missing).alias("column"))


def constraint_report(
    tables: dict[str, DataFrame],
    unique: dict[str, list[tuple[str, ...]]],
    not_null: dict[str, tuple[str, ...]],
    references: list[tuple[str, tuple[str, ...], str, tuple[str, ...]]],
) -> DataFrame:
    """``(table, rule, columns, key, n)`` of every rule that the given tables break.

    ``rule`` is ``unique`` (``n`` rows hold the key), ``not null`` (``n`` rows lack the
    column, no key) or ``reference`` (``n`` rows point to a key no parent holds).  Rules of
    tables not given are left out; so are references to them.  One aggregation a key, one a
    table for its columns, and one anti join a pair of tables.
    """
    def row(table: str, rule: str, columns: Column, key: Column) -> list[Column]:
        return [
            F.lit(table).alias("table"), F.lit(rule).alias("rule"), columns.alias("columns"), key.alias("key"), F.col("n")
        ]

    parts = []
    for table, keys in unique.items():
        for key in keys if table in tables else ():
            found = unique_violations(tables[table], list(key))
            parts.append(found.select(*row(table, "unique", F.lit(", ".join(key)), F.concat_ws(", ", *key))))
    for table, columns in not_null.items():
        if table in tables:
            found = not_null_violations(tables[table], columns, []).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
            parts.append(found.select(*row(table, "not null", F.col("column"), F.lit(None).cast("string"))))
    grouped: dict[tuple, dict[str, tuple[str, ...]]] = {}
    for child, columns, parent, parent_columns in references:
        if child in tables and parent in tables:
            grouped.setdefault((child, parent, parent_columns), {})[", ".join(columns)] = columns
    for (child, parent, parent_columns), refs in grouped.items():
        found = reference_violations(tables[child], refs, tables[parent], parent_columns)
        keys = [f"key_{i + 1}" for i in range(len(parent_columns))]
        parts.append(found.select(*row(child, "reference", F.col("reference"), F.concat_ws(", ", *keys))))
    if not parts:
        raise ValueError("no rule applies to the given tables")
    return reduce(DataFrame.unionByName, parts)


def cast_rejects(df: DataFrame, types: dict[str, T.DataType], keep: list[str]) -> DataFrame:
    """``(keep..., column, value)``: one row per text that does not fit its column type."""
    bad = F.array_compact(F.array(*[
        F.when(
            F.col(c).isNotNull() & clean.typed(c, t).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
        )
        for c, t in types.items()
    ]))
    return df.select(*keep, F.explode(bad).alias("b")).select(*keep, "b.column", "b.value")


def typed_table(df: DataFrame, layout: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Text columns cast to a layout; what does not fit is NULL here and a row of ``cast_rejects``."""
    return df.select(*keep, *[clean.typed(f.name, f.dataType).alias(f.name) for f in layout.fields])


def non_text(layout: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in layout.fields if not isinstance(f.dataType, T.StringType)}


def label_mismatch(labels: DataFrame, frames: DataFrame, label: str, framecode: str) -> DataFrame:
    """Rows whose label names no saveframe; a row without a label has nothing to match."""
    names = frames.select(F.col(framecode).alias("_name")).filter("_name IS NOT NULL").distinct()
    return labels.filter(F.col(label).isNotNull()).join(names, F.col(label) == F.col("_name"), "left_anti")


def unknown_components(
    entries: DataFrame, dictionary: DataFrame, entry_id: str = "Entry_ID", comp_id: str = "ID", key: str = "ID"
) -> DataFrame:
    """Distinct ``(ID, Entry_ID)`` used in entries but absent from the dictionary, by entry number."""
    number: Column = F.col(entry_id).try_cast(T.DecimalType(38, 0))
    known = dictionary.select(F.col(key).alias("_key")).distinct()
    return (
        entries.select(F.col(comp_id).alias("ID"), number.alias("Entry_ID"))
        .filter(F.col("ID").isNotNull())
        .distinct()
        .join(known, F.col("ID") == F.col("_key"), "left_anti")
        .orderBy("Entry_ID", "ID")
    )


def category_order(items: DataFrame, category: str, seq: str, where: Column | None = None) -> DataFrame:
    """Categories by the smallest sequence number of their items."""
    rows = items if where is None else items.filter(where)
    return rows.groupBy(category).agg(F.min(seq).alias("first_seq")).orderBy("first_seq", category)


def _violators(
    tables: dict[str, DataFrame], component: dict[str, str], unique, not_null, references
) -> DataFrame:
    """``(comp, reason)``: components (upper case) with a row that breaks a rule in any table.

    A unique key must hold the component column; rows with a NULL component are no component's.
    """
    parts = []
    for table, df in tables.items():
        comp = component[table]
        for key in unique.get(table, ()):
            if comp in key:
                found = unique_violations(df, list(key))
                parts.append(found.select(F.upper(F.col(comp)).alias("comp"), F.lit(f"duplicate {table} ({', '.join(key)})").alias("reason")))
        for column in not_null.get(table, ()):
            if column in df.columns and column != comp:
                found = df.filter(F.col(column).isNull())
                parts.append(found.select(F.upper(F.col(comp)).alias("comp"), F.lit(f"null {table}.{column}").alias("reason")))
    for child, columns, parent, parent_columns in references:
        if child in tables and parent in tables:
            names = [f"_k{i}" for i in range(len(columns))]
            known = tables[parent].select(*[F.col(c).alias(n) for c, n in zip(parent_columns, names)]).dropna().distinct()
            refs = tables[child].select(F.col(component[child]).alias("_comp"), *[F.col(c).alias(n) for c, n in zip(columns, names)]).dropna(subset=names)
            found = refs.join(known, names, "left_anti")
            parts.append(found.select(F.upper("_comp").alias("comp"), F.lit(f"orphan {child} ({', '.join(columns)})").alias("reason")))
    return reduce(DataFrame.unionByName, parts).filter(F.col("comp").isNotNull()).distinct()


def constraint_closure(
    tables: dict[str, DataFrame], component: dict[str, str], unique, not_null, references, max_rounds: int = 100,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Reject whole components that break a key, not-null or reference rule in any table.

    Returns ``(rejected (comp, reason), tables without the rejected components)``.  Taking a
    component out can leave rows of other components without their parent, so references are
    checked again on what is left until no component is added: the closure.  Keys move between
    rounds, never rows; ``max_rounds`` only guards against a defect and raises when reached.
    """
    from compdict.checkpoints import cut

    def without(keys: DataFrame) -> dict[str, DataFrame]:
        keys = keys.select(F.col("comp").alias("_rejected"))
        return {t: df.join(keys, F.upper(F.col(component[t])) == F.col("_rejected"), "left_anti") for t, df in tables.items()}

    rejected = cut(_violators(tables, component, unique, not_null, references))
    for _ in range(max_rounds):
        keys = rejected.select("comp").distinct()
        left = without(keys)
        more = cut(_violators(left, component, {}, {}, references).join(keys, "comp", "left_anti"))
        if more.isEmpty():
            return rejected, left
        rejected = cut(rejected.unionByName(more))
    raise RuntimeError("constraint closure did not settle")
