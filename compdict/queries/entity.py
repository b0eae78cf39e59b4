"""Entity rows, publishing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import shared_folder
from compdict.operators import ids
from compdict.plans import entity, publish, refresh
from compdict.queries.registry import Roles, query

_ENTITY = """entity AS (SELECT "ID" AS comp,
  CAST((SELECT max("Sf_ID") FROM star_component) + row_number() OVER (ORDER BY "ID") AS INTEGER) AS sf FROM star_component)"""


def entities(r: Roles) -> dict[str, DataFrame]:
    return entity.build_entities(r.star_component)


def linked(r: Roles) -> DataFrame:
    """Components joined with a stored entity table; its IDs follow those of the components."""
    stored = ids.surrogate_ids(
        entity.map_entity(r.star_component), "Nonpolymer_comp_ID", "Sf_ID", ids.next_id((r.star_component, "Sf_ID"))
    )
    return entity.linked(r.star_component, stored)


@query("build_entity", f"""
WITH {_ENTITY}
SELECT 'entity' AS "Sf_category", 'entity_' || "ID" AS "Sf_framecode", 'NEED_ACC_NO' AS "Entry_ID", entity.sf AS "Sf_ID",
  1 AS "Entity_ID", "BMRB_code", coalesce("Name", 'entity_' || "ID") AS "Name",
  CASE WHEN upper("Name") = 'WATER' THEN 'water' ELSE 'non-polymer' END AS "Type",
  1 AS "Number_of_nonpolymer_components", "ID" AS "Nonpolymer_comp_ID", 'chem_comp_' || "ID" AS "Nonpolymer_comp_label",
  "Paramagnetic", "Formula_weight"
FROM star_component JOIN entity ON comp = "ID"
""")
def build_entity(r: Roles) -> DataFrame:
    return entities(r)["Entity"].select(
        "Sf_category", "Sf_framecode", "Entry_ID", "Sf_ID", F.col("ID").alias("Entity_ID"), "BMRB_code", "Name", "Type",
        "Number_of_nonpolymer_components", "Nonpolymer_comp_ID", "Nonpolymer_comp_label", "Paramagnetic", "Formula_weight",
    )


@query("entity_common_name", f"""
WITH {_ENTITY}
SELECT c."Name", 'BMRB' AS "Type", e.sf AS "Sf_ID", 'NEED_ACC_NO' AS "Entry_ID"
FROM star_component c JOIN entity e ON e.comp = c."ID"
""")
def entity_common_name(r: Roles) -> DataFrame:
    return entity.common_name(linked(r))


@query("entity_systematic_name", f"""
WITH {_ENTITY}
SELECT c."Name", 'BMRB' AS "Naming_system", e.sf AS "Sf_ID", 'NEED_ACC_NO' AS "Entry_ID"
FROM star_component c JOIN entity e ON e.comp = c."ID"
UNION ALL
SELECT coalesce(c."Three_letter_code", c."ID"), 'Three letter code', e.sf, 'NEED_ACC_NO'
FROM star_component c JOIN entity e ON e.comp = c."ID"
""")
def entity_systematic_name(r: Roles) -> DataFrame:
    return entity.systematic_name(linked(r))


@query("entity_comp_index", f"""
WITH {_ENTITY}
SELECT 1 AS "ID", '1' AS "Auth_seq_ID", 1 AS "Entity_ID", c."ID" AS "Comp_ID", 'chem_comp_' || c."ID" AS "Comp_label",
  e.sf AS "Sf_ID", 'NEED_ACC_NO' AS "Entry_ID"
FROM star_component c JOIN entity e ON e.comp = c."ID"
""")
def entity_comp_index(r: Roles) -> DataFrame:
    return entity.comp_index(linked(r))


@query("public_dump", """
SELECT "ID", "Name", "Three_letter_code", "Formula_weight", "Sf_ID" FROM star_component
""")
def public_dump(r: Roles) -> DataFrame:
    """Written to the shared folder and read back."""
    columns = ["ID", "Name", "Three_letter_code", "Formula_weight", "Sf_ID"]
    path = f"{shared_folder(r.spark)}/public-{uuid.uuid4().hex}"
    publish.public_dump(r.star_component, path, "ID", columns, buckets=8)
    return r.spark.read.parquet(path).select(*columns)


def _sql_value(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '.' WHEN contains({c}, ' ') THEN '''' || {c} || '''' ELSE {c} END"


_HEAD = ("ID", "Name", "Three_letter_code")
_BOND = ("ID", "Atom_ID_1", "Atom_ID_2", "Value_order")


@query("saveframe_text", """
WITH have AS (SELECT DISTINCT "Comp_ID" AS c FROM star_bond)
SELECT "ID" AS comp_id, 0 AS section, CAST(0 AS BIGINT) AS ordinal, 0 AS sub, 'save_' || "Sf_framecode" AS line FROM star_component
""" + "".join(
    f"""UNION ALL SELECT "ID", 0, 0, {i + 1}, '   _Chem_comp.{c}  ' || {_sql_value(f'"{c}"')} FROM star_component\n"""
    for i, c in enumerate(_HEAD)
) + "UNION ALL SELECT c, 1, 0, 0, '   loop_' FROM have\n" + "".join(
    f"UNION ALL SELECT c, 1, 0, {i + 1}, '      _Chem_comp_bond.{c}' FROM have\n" for i, c in enumerate(_BOND)
) + """UNION ALL SELECT "Comp_ID", 2, "ID", 0, '     ' || CAST("ID" AS STRING) || ' ' || "Atom_ID_1" || ' ' || "Atom_ID_2" || ' ' || "Value_order"
  FROM star_bond
UNION ALL SELECT c, 3, 0, 0, '   stop_' FROM have
UNION ALL SELECT "ID", 4, 0, 0, 'save_' FROM star_component
""")
def saveframe_text(r: Roles) -> DataFrame:
    return publish.saveframe_lines(
        r.star_component, "ID", "Sf_framecode", "Chem_comp",
        {"Chem_comp_bond": (r.star_bond.select("Comp_ID", *_BOND), "Comp_ID", "ID")}, list(_HEAD),
    )


_REMOVE_KEYS = {
    "Chem_comp": "ID", "Chem_comp_atom": "Comp_ID", "Chem_comp_bond": "Comp_ID", "Entity": "Nonpolymer_comp_ID",
    "Entity_comp_index": "Comp_ID", "Entity_common_name": "Sf_ID", "Entity_systematic_name": "Sf_ID",
}


@query("star_remove", f"""
WITH {_ENTITY},
gone AS (SELECT upper(CAST("ID" AS VARCHAR)) AS k FROM star_component WHERE "BMRB_code" = 'own'),
kept AS (SELECT * FROM entity WHERE upper(CAST(comp AS VARCHAR)) NOT IN (SELECT k FROM gone))
SELECT 'Chem_comp' AS tbl, CAST("ID" AS VARCHAR) AS comp, count(*) AS n FROM star_component
  WHERE upper(CAST("ID" AS VARCHAR)) NOT IN (SELECT k FROM gone) GROUP BY 2
UNION ALL SELECT 'Chem_comp_atom', "Comp_ID", count(*) FROM star_atom
  WHERE "Comp_ID" IS NULL OR upper("Comp_ID") NOT IN (SELECT k FROM gone) GROUP BY 2
UNION ALL SELECT 'Chem_comp_bond', "Comp_ID", count(*) FROM star_bond
  WHERE "Comp_ID" IS NULL OR upper("Comp_ID") NOT IN (SELECT k FROM gone) GROUP BY 2
UNION ALL SELECT 'Entity', CAST(comp AS VARCHAR), count(*) FROM kept GROUP BY 2
UNION ALL SELECT 'Entity_comp_index', CAST(comp AS VARCHAR), count(*) FROM kept GROUP BY 2
UNION ALL SELECT 'Entity_common_name', CAST(sf AS VARCHAR), count(*) FROM kept GROUP BY 2
UNION ALL SELECT 'Entity_systematic_name', CAST(sf AS VARCHAR), 2 * count(*) FROM kept GROUP BY 2
""")
def star_remove(r: Roles) -> DataFrame:
    """Components of this side's own code (``BMRB_code = 'own'``) removed from the STAR tables along
    the reference graph; rows left per table and component (names: per saveframe)."""
    star = {"Chem_comp": r.star_component, "Chem_comp_atom": r.star_atom, "Chem_comp_bond": r.star_bond, **entities(r)}
    gone = r.star_component.filter("BMRB_code = 'own'").select(F.upper(F.col("ID").cast("string")).alias("_key"))
    left = refresh.remove_components(star, gone)
    counted = [
        left[t].groupBy(F.col(k).cast("string").alias("comp")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "comp", "n")
        for t, k in _REMOVE_KEYS.items()
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out
