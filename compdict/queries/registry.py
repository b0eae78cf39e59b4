"""Registration of queries and the role tables they run on.

A role is a driver table seen as a table of the dictionary, written once in SQL that
Spark and DuckDB both run.  Rows are never left out to make a role small; which rows a
role holds is decided by attributes such as status or priority.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from compdict import schema

QUERIES = {}
ORACLES = {}

TABLES = ("orders", "lineitem", "customer", "part", "events", "documents", "pages", "conversations", "supplier")


def query(name: str, sql: str | None = None):
    """Register a query ``f(roles) -> DataFrame`` and its SQL (roles are prepended as CTEs)."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Roles(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_roles(sql)
        return fn

    return register


def _select(columns: dict[str, str], source: str, layout=None) -> str:
    if layout is not None:
        kinds = {"string": "STRING", "int": "INT", "date": "DATE"}
        columns = {
            f.name: columns.get(f.name, f"CAST(NULL AS {kinds[f.dataType.simpleString()]})") for f in layout.fields
        }
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT\n  {cols}\nFROM {source}"


_KEY = "CAST(o_orderkey AS STRING)"
_DAY = "CAST(o_orderdate AS DATE)"
_LINE = "CAST(l_orderkey AS STRING)"


def _later(days: int) -> str:
    return f"CAST({_DAY} + INTERVAL '{days}' DAY AS DATE)"


_COMPONENT = {
    "id": _KEY,
    "name": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'Water'"
            " ELSE 'name ' || CAST(o_custkey AS STRING) END",
    "type": "lower(o_orderpriority)",
    "pdbx_ambiguous_flag": "CASE o_orderkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'y' WHEN 3 THEN 'maybe' END",
    "mon_nstd_flag": "CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'n' END",
    "pdbx_model_coordinates_missing_flag": "CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END",
    "pdbx_ideal_coordinates_missing_flag": "CASE WHEN o_orderstatus = 'F' THEN 'y' END",
    "pdbx_initial_date": f"CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_DAY} END",
    "pdbx_modified_date": f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_later(30)} END",
    "pdbx_release_status": "CASE WHEN o_orderkey % 19 = 0 THEN 'OBS' WHEN o_orderkey % 23 = 0 THEN ' wdrn ' ELSE 'REL' END",
    "pdbx_replaced_by": "CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey AS STRING) END",
    "pdbx_subcomponent_list": "CASE WHEN o_orderkey % 13 = 0 THEN 'A B' END",
    "pdbx_replaces": "CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_custkey AS STRING) END",
    "pdbx_synonyms": "CASE WHEN o_orderkey % 8 = 0 THEN '  a; b ' WHEN o_orderkey % 8 = 1 THEN ' ? '"
                     " WHEN o_orderkey % 8 = 2 THEN '' END",
    "pdbx_formal_charge": "CAST(o_orderkey % 3 AS STRING)",
    "pdbx_processing_site": "o_orderpriority",
    "one_letter_code": "o_orderstatus",
    "three_letter_code": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE substring(o_orderpriority, 3, 3) END",
    "number_atoms_all": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 50 AS INT) END",
    "number_atoms_nh": "CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 40 AS INT) END",
    "formula": "'C' || CAST(o_custkey AS STRING) || ' H' || CAST(o_orderkey % 9 AS STRING)",
    "formula_weight": "CAST(o_custkey AS STRING) || '.' || CAST(o_orderkey % 1000 AS STRING)",
}

_N = "CAST(l_linenumber AS STRING)"
_ATOM = {
    "comp_id": _LINE,
    "atom_id": f"'A' || {_N}",
    "alt_atom_id": "'P' || CAST(l_partkey AS STRING)",
    "type_symbol": "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_returnflag END",
    "charge": "CAST(l_linenumber % 3 AS STRING)",
    "pdbx_align": f"CASE WHEN l_linenumber = 7 THEN '1.5' ELSE {_N} END",
    "pdbx_aromatic_flag": "CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END",
    "pdbx_leaving_atom_flag": "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
    "pdbx_stereo_config": "l_linestatus",
    "pdbx_ordinal": "CAST(l_linenumber AS INT)",
    "model_cartn_x": "CAST(l_partkey AS STRING) || '.50'",
    "model_cartn_y": "CAST(l_suppkey AS STRING) || '.10'",
    "pdbx_model_cartn_z_ideal": "'-' || CAST(l_partkey AS STRING)",
}


def _atom_ref(step: int) -> str:
    return f"'A' || CAST(l_linenumber + {step} AS STRING)" if step else f"'A' || {_N}"


_STAR_ATOM = {
    "Comp_ID": _LINE,
    "Atom_ID": f"'A' || {_N}",
    "Type_symbol": _ATOM["type_symbol"],
    "BMRB_code": "CASE WHEN l_linenumber = 2 THEN 'kept' END",
    "PDB_atom_ID": "CASE WHEN l_linestatus = 'O' THEN 'own ' || l_returnflag END",
    "Sf_ID": "CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN -1 END",
}

ROLES = {
    # CIF side
    "component": _select(_COMPONENT, "{orders}", schema.CIF["chem_comp"]),
    "atom": _select(_ATOM, "{lineitem}", schema.CIF["chem_comp_atom"]),
    "bond": _select({
        "comp_id": _LINE, "atom_id_1": _atom_ref(0), "atom_id_2": _atom_ref(1),
        "pdbx_aromatic_flag": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Y' ELSE 'N' END",
        "pdbx_ordinal": "CAST(l_linenumber AS INT)", "pdbx_stereo_config": "l_linestatus",
        "value_order": "CASE WHEN l_linestatus = 'O' THEN 'SING' ELSE 'DOUB' END",
    }, "{lineitem}", schema.CIF["chem_comp_bond"]),
    "torsion": _select({
        "comp_id": _LINE, "id": f"CASE WHEN l_suppkey % 50 = 0 THEN 't' || {_N} ELSE {_N} END",
        **{f"atom_id_{i + 1}": _atom_ref(i) for i in range(4)},
    }, "{lineitem}", schema.CIF["chem_comp_tor"]),
    "angle": _select({
        "comp_id": _LINE, "atom_id_1": _atom_ref(0), "atom_id_2": "'P' || CAST(l_partkey AS STRING)",
        "atom_id_3": "'S' || CAST(l_suppkey AS STRING)",
    }, "{lineitem}", schema.CIF["chem_comp_angle"]),
    "descriptor": _select({
        "comp_id": "CAST(user_id AS STRING)",
        "descriptor": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'InChI=1S/' || props END",
        "ordinal": "CAST(event_id % 1000 AS INT)", "program": "event_type",
        "program_version": "CAST(event_id % 7 AS STRING)",
        "type": "CASE event_type WHEN 'view' THEN 'InChI' WHEN 'click' THEN 'INCHI' ELSE 'SMILES' END",
    }, "{events}", schema.CIF["pdbx_chem_comp_descriptor"]),
    "identifier": _select({
        "comp_id": "CAST(user_id AS STRING)", "identifier": "props", "type": "'SYSTEMATIC NAME'",
        "program": "event_type", "program_version": "CAST(event_id % 5 AS STRING)",
    }, "{events}", schema.CIF["pdbx_chem_comp_identifier"]),
    "feature": _select({
        "comp_id": "CAST(p_partkey AS STRING)", "source": "p_type", "support": "CAST(p_size AS STRING)",
        "type": "p_brand", "value": "p_name",
    }, "{part}", schema.CIF["pdbx_chem_comp_feature"]),
    # what an earlier run stored: two thirds of the orders, some older, and customers as components since gone
    "stored": f"""SELECT lower('c' || {_KEY}) AS id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_DAY} END AS created,
  CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 41 = 0 THEN NULL
       WHEN o_orderpriority = '2-HIGH' THEN {_later(28)} ELSE {_later(30)} END AS modified
FROM {{orders}} WHERE o_orderstatus <> 'O'
UNION ALL
SELECT 'gone' || CAST(c_custkey AS STRING), DATE '1999-07-08', DATE '2011-06-04' FROM {{customer}}""",
    # what a scan finds now
    "scanned": f"""SELECT 'C' || {_KEY} AS id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_DAY} END AS created,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_later(30)} END AS modified,
  o_orderkey % 43 = 0 AS error,
  {_COMPONENT['pdbx_release_status']} AS release_status,
  {_COMPONENT['pdbx_replaced_by']} AS replaced_by,
  {_COMPONENT['pdbx_subcomponent_list']} AS subcomponents
FROM {{orders}}""",
    # child rows of the earlier run, all of its components and one row per gone component
    "stored_atom": """SELECT 'c' || CAST(l_orderkey AS STRING) AS comp_id, CAST(l_linenumber AS INT) AS ordinal,
  'old ' || flags AS atom_id
FROM (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS flags FROM {lineitem}) x
UNION ALL
SELECT 'GONE' || CAST(c_custkey AS STRING), 0, c_mktsegment FROM {customer}""",
    "scanned_atom": """SELECT 'C' || CAST(l_orderkey AS STRING) AS comp_id, CAST(l_linenumber AS INT) AS ordinal,
  'new ' || l_returnflag || CAST(l_partkey AS STRING) AS atom_id
FROM {lineitem}""",
    # STAR side
    "local": f"""SELECT {_KEY} AS id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_DAY} END AS created,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN {_DAY}
       WHEN o_orderstatus = 'P' THEN {_later(10)} ELSE {_later(60)} END AS modified
FROM {{orders}} WHERE o_orderpriority <> '3-MEDIUM'""",
    "star_component": _select({
        "ID": _KEY, "Name": _COMPONENT["name"], "Type": "lower(o_orderpriority)",
        "BMRB_code": "CASE WHEN o_orderstatus = 'F' THEN 'own' END", "PDB_code": "CASE WHEN o_orderkey % 2 = 0 THEN 'P' END",
        "Sf_ID": "CAST(o_orderkey + 1 AS INT)", "Sf_framecode": f"'chem_comp' || {_KEY}",
        "Three_letter_code": _COMPONENT["three_letter_code"], "Paramagnetic": "CASE WHEN o_orderkey % 4 = 0 THEN 'no' END",
        "Formula_weight": _COMPONENT["formula_weight"],
        "Number_atoms_all": _COMPONENT["number_atoms_all"], "Number_atoms_nh": _COMPONENT["number_atoms_nh"],
        "Aromatic": "CASE WHEN o_orderkey % 10 = 0 THEN 'kept' END",
        "InChI_code": "CASE WHEN o_orderkey % 10 = 1 THEN 'kept' END",
        "Initial_date": _DAY, "Modified_date": _later(10),
    }, "{orders}"),
    "star_atom": _select(_STAR_ATOM, "{lineitem}"),
    "star_bond": _select({
        "Comp_ID": _LINE, "ID": "CAST(l_linenumber AS INT)", "Atom_ID_1": _atom_ref(0), "Atom_ID_2": _atom_ref(1),
        "Value_order": "CASE WHEN l_linestatus = 'O' THEN 'SING' ELSE 'DOUB' END",
        "Aromatic_flag": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Y'"
                         " WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'yes' ELSE 'N' END",
    }, "{lineitem}"),
}


class Roles:
    """Role tables and driver tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, role: str) -> DataFrame:
        if role in TABLES:
            return self.table(role)
        text = ROLES[role]
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def with_roles(sql: str) -> str:
    """Prepend the roles a query names as CTEs over the driver tables."""
    named = [r for r in ROLES if re.search(rf"\b{r}\b", sql)]
    if not named:
        return sql
    views = {t: t for t in TABLES}
    ctes = ",\n".join(f"{r} AS ({ROLES[r].format(**views)})" for r in named)
    rest = sql.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {ctes},\n{rest[5:]}"
    return f"WITH {ctes}\n{rest}"
