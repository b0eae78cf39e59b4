"""Keys, references, not-null rules, labels, unknown components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict import schema
from compdict.operators import quality
from compdict.plans import convert
from compdict.queries.registry import Roles, query


@query("unique_violations", """
SELECT comp_id, atom_id, count(*) AS n FROM atom GROUP BY comp_id, atom_id HAVING count(*) > 1
""")
def unique_violations(r: Roles) -> DataFrame:
    return quality.unique_violations(r.atom, ["comp_id", "atom_id"])


@query("fk_violations", """
WITH refs AS (SELECT 'atom_id_1' AS reference, comp_id AS key_1, atom_id_1 AS key_2 FROM bond
  UNION ALL SELECT 'atom_id_2', comp_id, atom_id_2 FROM bond)
SELECT reference, key_1, key_2, count(*) AS n FROM refs
WHERE NOT EXISTS (SELECT 1 FROM atom WHERE comp_id = key_1 AND atom_id = key_2)
GROUP BY reference, key_1, key_2
""")
def fk_violations(r: Roles) -> DataFrame:
    refs = {c: ("comp_id", c) for c in ("atom_id_1", "atom_id_2")}
    return quality.reference_violations(r.bond, refs, r.atom, ("comp_id", "atom_id"))


@query("orphan_components", """
SELECT 'comp_id' AS reference, comp_id AS key_1, count(*) AS n FROM feature
WHERE comp_id NOT IN (SELECT id FROM component WHERE pdbx_replaced_by IS NULL) GROUP BY comp_id
""")
def orphan_components(r: Roles) -> DataFrame:
    parents = r.component.filter("pdbx_replaced_by IS NULL")
    return quality.reference_violations(r.feature, {"comp_id": ("comp_id",)}, parents, ("id",))


@query("not_null_violations", """
SELECT comp_id, ordinal, 'descriptor' AS "column" FROM descriptor WHERE descriptor IS NULL
""")
def not_null_violations(r: Roles) -> DataFrame:
    return quality.not_null_violations(r.descriptor, ["descriptor", "type"], ["comp_id", "ordinal"])


@query("label_mismatch", """
SELECT id, 'chem_comp_' || id AS label FROM component
WHERE 'chem_comp_' || id NOT IN (SELECT CASE WHEN id IN (SELECT id FROM local) THEN 'chem_comp_' ELSE 'chem_comp' END || id FROM component)
""")
def label_mismatch(r: Roles) -> DataFrame:
    """Labels against framecodes, which carry the same prefix only where held locally."""
    labels = r.component.select("id", F.concat(F.lit("chem_comp_"), F.col("id")).alias("label"))
    held = r.local.select(F.col("id").alias("held"))
    frames = r.component.join(held, F.col("id") == F.col("held"), "left").select(
        F.concat(F.when(F.col("held").isNotNull(), "chem_comp_").otherwise("chem_comp"), F.col("id")).alias("frame")
    )
    return quality.label_mismatch(labels, frames, "label", "frame")


_ENTRIES = """SELECT CAST(l_orderkey AS STRING) AS ID,
  CASE WHEN l_linenumber = 7 THEN 'draft' ELSE CAST(l_suppkey AS STRING) END AS Entry_ID FROM {lineitem}"""


@query("unknown_components", f"""
SELECT DISTINCT "ID", CASE WHEN "Entry_ID" <> 'draft' THEN CAST("Entry_ID" AS DECIMAL(38, 0)) END AS "Entry_ID"
FROM ({_ENTRIES.format(lineitem='lineitem')}) e WHERE "ID" NOT IN (SELECT DISTINCT id FROM local)
""")
def unknown_components(r: Roles) -> DataFrame:
    entries = r.spark.sql(_ENTRIES, lineitem=r.lineitem)
    return quality.unknown_components(entries, r.local.withColumnRenamed("id", "ID"))


@query("unknown_count", f"""
SELECT count(*) AS n FROM (SELECT DISTINCT "ID", "Entry_ID"
FROM ({_ENTRIES.format(lineitem='lineitem')}) e WHERE "ID" NOT IN (SELECT DISTINCT id FROM local)) x
""")
def unknown_count(r: Roles) -> DataFrame:
    return unknown_components(r).agg(F.count(F.lit(1)).alias("n"))


@query("constraint_report", """
WITH refs AS (
  SELECT 'chem_comp_atom' AS t, 'comp_id' AS c, comp_id AS k, comp_id IN (SELECT id FROM component) AS known FROM atom
  UNION ALL SELECT 'pdbx_chem_comp_descriptor', 'comp_id', comp_id, comp_id IN (SELECT id FROM component) FROM descriptor
  UNION ALL SELECT t, c, comp_id || ', ' || a, (comp_id, a) IN (SELECT (comp_id, atom_id) FROM atom) FROM (
    SELECT 'chem_comp_bond' AS t, 'comp_id, atom_id_1' AS c, comp_id, atom_id_1 AS a FROM bond
    UNION ALL SELECT 'chem_comp_bond', 'comp_id, atom_id_2', comp_id, atom_id_2 FROM bond
    UNION ALL SELECT 'chem_comp_angle', 'comp_id, atom_id_1', comp_id, atom_id_1 FROM angle
    UNION ALL SELECT 'chem_comp_angle', 'comp_id, atom_id_2', comp_id, atom_id_2 FROM angle
    UNION ALL SELECT 'chem_comp_angle', 'comp_id, atom_id_3', comp_id, atom_id_3 FROM angle
    UNION ALL SELECT 'chem_comp_tor', 'comp_id, atom_id_1', comp_id, atom_id_1 FROM torsion
    UNION ALL SELECT 'chem_comp_tor', 'comp_id, atom_id_2', comp_id, atom_id_2 FROM torsion
    UNION ALL SELECT 'chem_comp_tor', 'comp_id, atom_id_3', comp_id, atom_id_3 FROM torsion
    UNION ALL SELECT 'chem_comp_tor', 'comp_id, atom_id_4', comp_id, atom_id_4 FROM torsion) x),
keys AS (
  SELECT 'chem_comp' AS t, 'id' AS c, id AS k FROM component
  UNION ALL SELECT 'chem_comp_atom', 'comp_id, atom_id', comp_id || ', ' || atom_id FROM atom
  UNION ALL SELECT 'chem_comp_tor', 'comp_id, id', comp_id || ', ' || id FROM torsion),
lacking AS (
  SELECT 'Descriptor' AS c, descriptor AS v FROM descriptor UNION ALL SELECT 'Type', type FROM descriptor
  UNION ALL SELECT 'Comp_ID', comp_id FROM descriptor)
SELECT t AS "table", 'reference' AS rule, c AS "columns", k AS "key", count(*) AS n FROM refs
WHERE k IS NOT NULL AND NOT known GROUP BY t, c, k
UNION ALL SELECT t, 'unique', c, k, count(*) FROM keys WHERE k IS NOT NULL GROUP BY t, c, k HAVING count(*) > 1
UNION ALL SELECT 'Chem_comp_descriptor', 'not null', c, NULL, count(*) FROM lacking WHERE v IS NULL GROUP BY c
""")
def constraint_report(r: Roles) -> DataFrame:
    """Rules of the CIF side, and the required values of mapped descriptors."""
    tables = {
        "chem_comp": r.component, "chem_comp_atom": r.atom, "chem_comp_bond": r.bond, "chem_comp_tor": r.torsion,
        "chem_comp_angle": r.angle, "pdbx_chem_comp_descriptor": r.descriptor,
        "Chem_comp_descriptor": convert.map_child(r.descriptor, "Chem_comp_descriptor"),
    }
    return quality.constraint_report(tables, schema.UNIQUE, schema.NOT_NULL, schema.REFERENCES)


_CLOSURE_TABLES = {
    "chem_comp": ("component", "id"), "chem_comp_atom": ("atom", "comp_id"), "chem_comp_bond": ("bond", "comp_id"),
    "chem_comp_tor": ("torsion", "comp_id"), "chem_comp_angle": ("angle", "comp_id"), "pdbx_chem_comp_descriptor": ("descriptor", "comp_id"),
}


def _closure_sql() -> str:
    """Violating components of the CIF role tables; their references stay within a component, so one round settles."""
    parts = []
    for table, (role, comp) in _CLOSURE_TABLES.items():
        for key in schema.UNIQUE.get(table, ()):
            if comp in key:
                cols = ", ".join(key)
                full = " AND ".join(f"{c} IS NOT NULL" for c in key)
                parts.append(f"SELECT upper({comp}) AS comp, 'duplicate {table} ({cols})' AS reason FROM {role} WHERE {full} GROUP BY {cols} HAVING count(*) > 1")
        for column in schema.NOT_NULL.get(table, ()):
            if column != comp:
                parts.append(f"SELECT upper({comp}), 'null {table}.{column}' FROM {role} WHERE {column} IS NULL")
    for child, columns, parent, parent_columns in schema.REFERENCES:
        if child in _CLOSURE_TABLES and parent in _CLOSURE_TABLES:
            role, comp = _CLOSURE_TABLES[child]
            prole = _CLOSURE_TABLES[parent][0]
            full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
            tuple_ = ", ".join(columns)
            ptuple = ", ".join(parent_columns)
            parts.append(
                f"SELECT upper({comp}), 'orphan {child} ({', '.join(columns)})' FROM {role} "
                f"WHERE {full} AND ({tuple_}) NOT IN (SELECT ({ptuple}) FROM {prole} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in parent_columns) + ")"
            )
    return "SELECT DISTINCT comp, reason FROM (\n" + "\nUNION ALL ".join(parts) + "\n) v WHERE comp IS NOT NULL"


@query("constraint_closure", _closure_sql())
def constraint_closure(r: Roles) -> DataFrame:
    """Components that break a key, not-null or reference rule in any CIF table, rejected whole."""
    tables = {t: getattr(r, role) for t, (role, _) in _CLOSURE_TABLES.items()}
    component = {t: comp for t, (_, comp) in _CLOSURE_TABLES.items()}
    rejected, _ = quality.constraint_closure(tables, component, schema.UNIQUE, schema.NOT_NULL, schema.REFERENCES)
    return rejected
