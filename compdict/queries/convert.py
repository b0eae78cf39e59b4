"""CIF side to STAR side: column mappings, derived facts, identity."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict import schema
from compdict.operators import derive, ids, merge
from compdict.plans import convert
from compdict.queries.registry import Roles, query

_AS_OF = date(2021, 3, 4)
_DAY = "DATE '2021-03-04'"


def _yes(c: str) -> str:
    return f"CASE WHEN upper({c}) = 'Y' THEN 'yes' ELSE 'no' END"


def _cast(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS INTEGER) END"


@query("map_component", f"""
SELECT id AS "ID", coalesce(name, id) AS "Name", upper(type) AS "Type", {_yes('pdbx_ambiguous_flag')} AS "Ambiguous_flag",
  {_DAY} AS "Initial_date", {_DAY} AS "Modified_date", pdbx_release_status AS "Release_status",
  pdbx_replaced_by AS "Replaced_by", pdbx_replaces AS "Replaces", one_letter_code AS "One_letter_code",
  three_letter_code AS "Three_letter_code", number_atoms_all AS "Number_atoms_all", number_atoms_nh AS "Number_atoms_nh",
  {_yes('mon_nstd_flag')} AS "Mon_nstd_flag", mon_nstd_class AS "Mon_nstd_class", mon_nstd_details AS "Mon_nstd_details",
  mon_nstd_parent AS "Mon_nstd_parent", mon_nstd_parent_comp_id AS "Mon_nstd_parent_comp_ID", pdbx_synonyms AS "Synonyms",
  pdbx_formal_charge AS "Formal_charge", formula AS "Formula", formula_weight AS "Formula_weight",
  model_details AS "Model_details", model_erf AS "Model_erf", model_source AS "Model_source",
  pdbx_model_coordinates_details AS "Model_coordinates_details",
  {_yes('pdbx_model_coordinates_missing_flag')} AS "Model_coordinates_missing_flag",
  pdbx_ideal_coordinates_details AS "Ideal_coordinates_details",
  {_yes('pdbx_ideal_coordinates_missing_flag')} AS "Ideal_coordinates_missing_flag",
  pdbx_model_coordinates_db_code AS "Model_coordinates_db_code", pdbx_processing_site AS "Processing_site",
  'NEED_ACC_NO' AS "Entry_ID", 'PDB' AS "Provenance", 'chem_comp' AS "Sf_category", 'chem_comp' || id AS "Sf_framecode"
FROM component
WHERE pdbx_replaced_by IS NULL AND pdbx_subcomponent_list IS NULL AND id NOT IN (SELECT id FROM local)
""")
def map_component(r: Roles) -> DataFrame:
    fresh = merge.new_only(r.component, r.local.withColumnRenamed("id", "ID"), "id", "ID")
    out = convert.map_component(fresh, _AS_OF)
    empty = ("Sf_ID", "BMRB_code", "PDB_code", "InChI_code", "Aromatic", "Subcomponent_list", "Paramagnetic",
             "Atom_nomenclature_source", "PubChem_code", "Vendor", "Vendor_product_code", "Details")
    unmapped = [c for c in out.columns if c.startswith(("Std_", "Formula_mono", "Image_", "Topo_", "Struct_", "Stereochem_", "DB_"))]
    return out.drop(*empty, *unmapped)


_PROGRAM = """type AS "Type", program AS "Program", program_version AS "Program_version",
  CAST(NULL AS INTEGER) AS "Sf_ID", 'NEED_ACC_NO' AS "Entry_ID", comp_id AS "Comp_ID\""""


@query("map_descriptor", f'SELECT descriptor AS "Descriptor", {_PROGRAM} FROM descriptor')
def map_descriptor(r: Roles) -> DataFrame:
    return convert.map_child(r.descriptor, "Chem_comp_descriptor")


@query("map_identifier", f'SELECT identifier AS "Identifier", {_PROGRAM} FROM identifier')
def map_identifier(r: Roles) -> DataFrame:
    return convert.map_child(r.identifier, "Chem_comp_identifier")


@query("map_feature", """
SELECT type AS "Type", value AS "Value", source AS "Source", support AS "Support", CAST(NULL AS INTEGER) AS "Sf_ID",
  'NEED_ACC_NO' AS "Entry_ID", comp_id AS "Comp_ID" FROM feature
""")
def map_feature(r: Roles) -> DataFrame:
    return convert.map_child(r.feature, "PDBX_chem_comp_feature")


@query("map_atom", f"""
SELECT comp_id AS "Comp_ID", atom_id AS "Atom_ID", alt_atom_id AS "Alt_atom_ID", type_symbol AS "Type_symbol",
  pdbx_stereo_config AS "Stereo_config", charge AS "Charge", partial_charge AS "Partial_charge",
  {_cast('pdbx_align')} AS "Align", pdbx_aromatic_flag AS "Aromatic_flag", pdbx_leaving_atom_flag AS "Leaving_atom_flag",
  substruct_code AS "Substruct_code", model_cartn_x AS "Model_Cartn_x", model_cartn_x_esd AS "Model_Cartn_x_esd",
  model_cartn_y AS "Model_Cartn_y", model_cartn_y_esd AS "Model_Cartn_y_esd", model_cartn_z AS "Model_Cartn_z",
  model_cartn_z_esd AS "Model_Cartn_z_esd", pdbx_model_cartn_x_ideal AS "Model_Cartn_x_ideal",
  pdbx_model_cartn_y_ideal AS "Model_Cartn_y_ideal", pdbx_model_cartn_z_ideal AS "Model_Cartn_z_ideal",
  pdbx_ordinal AS "PDBX_ordinal", 'NEED_ACC_NO' AS "Entry_ID", atom_id AS "BMRB_code", atom_id AS "PDB_atom_ID"
FROM atom
""")
def map_atom(r: Roles) -> DataFrame:
    out = convert.fill_atom_codes(convert.map_child(r.atom, "Chem_comp_atom"))
    return out.drop(
        "Auth_atom_ID", "Isotope_number", "Chirality", "Oxidation_number", "Unpaired_electron_number", "Ionizable",
        "Drawing_2D_coord_x", "Drawing_2D_coord_y", "Details", "Sf_ID",
    )


@query("map_bond", """
SELECT pdbx_ordinal AS "ID", CAST(NULL AS STRING) AS "Type", value_order AS "Value_order", atom_id_1 AS "Atom_ID_1",
  atom_id_2 AS "Atom_ID_2", pdbx_aromatic_flag AS "Aromatic_flag", pdbx_stereo_config AS "Stereo_config",
  pdbx_ordinal AS "Ordinal", CAST(NULL AS STRING) AS "Details", CAST(NULL AS INTEGER) AS "Sf_ID",
  'NEED_ACC_NO' AS "Entry_ID", comp_id AS "Comp_ID"
FROM bond
""")
def map_bond(r: Roles) -> DataFrame:
    return convert.map_child(r.bond, "Chem_comp_bond")


@query("map_torsion", f"""
SELECT {_cast('id')} AS "ID", atom_id_1 AS "Atom_ID_1", atom_id_2 AS "Atom_ID_2", atom_id_3 AS "Atom_ID_3",
  atom_id_4 AS "Atom_ID_4", CAST(NULL AS STRING) AS "Details", CAST(NULL AS INTEGER) AS "Sf_ID",
  'NEED_ACC_NO' AS "Entry_ID", comp_id AS "Comp_ID"
FROM torsion
""")
def map_torsion(r: Roles) -> DataFrame:
    return convert.map_child(r.torsion, "Chem_comp_tor")


@query("map_rejects", f"""
SELECT comp_id, 'id' AS "column", id AS value FROM torsion WHERE {_cast('id')} IS NULL
UNION ALL SELECT comp_id, 'pdbx_align', pdbx_align FROM atom WHERE {_cast('pdbx_align')} IS NULL
""")
def map_rejects(r: Roles) -> DataFrame:
    """What the typed columns of torsions and atoms do not take."""
    return convert.map_rejects(r.torsion, "Chem_comp_tor").unionByName(convert.map_rejects(r.atom, "Chem_comp_atom"))


@query("map_angle", """
SELECT CAST(row_number() OVER (PARTITION BY comp_id ORDER BY atom_id_1, atom_id_2, atom_id_3) AS INTEGER) AS "ID",
  atom_id_1 AS "Atom_ID_1", atom_id_2 AS "Atom_ID_2", atom_id_3 AS "Atom_ID_3", 'NEED_ACC_NO' AS "Entry_ID",
  comp_id AS "Comp_ID"
FROM angle
""")
def map_angle(r: Roles) -> DataFrame:
    out = convert.map_child(r.angle, "Chem_comp_angle").drop("ID", "Details", "Sf_ID")
    return ids.number_within(out, ["Comp_ID"], ["Atom_ID_1", "Atom_ID_2", "Atom_ID_3"], "ID")


@query("fill_nulls", """
SELECT "ID", coalesce("BMRB_code", "ID") AS "BMRB_code", coalesce("PDB_code", "ID") AS "PDB_code" FROM star_component
""")
def fill_nulls(r: Roles) -> DataFrame:
    return convert.fill_codes(r.star_component).select("ID", "BMRB_code", "PDB_code")


@query("fill_atom_codes", """
SELECT "Comp_ID", "Atom_ID", coalesce("BMRB_code", "Atom_ID") AS "BMRB_code",
  coalesce("PDB_atom_ID", "Atom_ID") AS "PDB_atom_ID" FROM star_atom
""")
def fill_atom_codes(r: Roles) -> DataFrame:
    return convert.fill_atom_codes(r.star_atom).select("Comp_ID", "Atom_ID", "BMRB_code", "PDB_atom_ID")


@query("backfill_parent_id", """
SELECT a."Comp_ID", a."Atom_ID", coalesce(a."Sf_ID", (SELECT c."Sf_ID" FROM star_component c WHERE c."ID" = a."Comp_ID")) AS "Sf_ID"
FROM star_atom a
""")
def backfill_parent_id(r: Roles) -> DataFrame:
    return derive.backfill(r.star_atom, r.star_component, "Comp_ID", "ID", {"Sf_ID": "Sf_ID"}).select(
        "Comp_ID", "Atom_ID", "Sf_ID"
    )


def _with_star(r: Roles, child: DataFrame, facts: dict[str, derive.Fact]) -> DataFrame:
    return derive.derive(r.star_component, child, "ID", "Comp_ID", facts).select("ID", *facts)


@query("count_children", """
SELECT "ID", coalesce("Number_atoms_all", CAST((SELECT count(*) FROM star_atom WHERE "Comp_ID" = "ID") AS INTEGER))
  AS "Number_atoms_all"
FROM star_component
""")
def count_children(r: Roles) -> DataFrame:
    return _with_star(r, r.star_atom, {"Number_atoms_all": derive.row_count()})


@query("count_non_h", """
SELECT "ID", coalesce("Number_atoms_nh",
  CAST((SELECT count(*) FROM star_atom WHERE "Comp_ID" = "ID" AND "Type_symbol" <> 'R') AS INTEGER)) AS "Number_atoms_nh"
FROM star_component
""")
def count_non_h(r: Roles) -> DataFrame:
    return _with_star(r, r.star_atom, {"Number_atoms_nh": derive.count_not_equal("Type_symbol", "R")})


@query("exists_flag", """
SELECT c."ID", coalesce(c."Aromatic", CASE WHEN (SELECT count(*) FROM star_bond b
  WHERE upper(b."Aromatic_flag") IN ('Y', 'YES') AND b."Comp_ID" = c."ID") > 0 THEN 'yes' ELSE 'no' END) AS "Aromatic"
FROM star_component c
""")
def exists_flag(r: Roles) -> DataFrame:
    return _with_star(r, r.star_bond, {"Aromatic": derive.any_flag("Aromatic_flag")})


@query("exists_flag_as_written", """
SELECT c."ID", coalesce(c."Aromatic", CASE WHEN (SELECT count(*) FROM star_bond b
  WHERE b."Aromatic_flag" = 'yes' AND b."Comp_ID" = c."ID") > 0 THEN 'yes' ELSE 'no' END) AS "Aromatic"
FROM star_component c
""")
def exists_flag_as_written(r: Roles) -> DataFrame:
    return _with_star(r, r.star_bond, {"Aromatic": derive.exact_flag("Aromatic_flag")})


@query("first_descriptor", """
SELECT "ID", coalesce("InChI_code", (SELECT min(descriptor) FROM descriptor WHERE upper(type) = 'INCHI'
  AND comp_id = "ID" AND descriptor IS NOT NULL)) AS "InChI_code"
FROM star_component
""")
def first_descriptor(r: Roles) -> DataFrame:
    descriptors = convert.map_child(r.descriptor, "Chem_comp_descriptor")
    return _with_star(r, descriptors, {"InChI_code": derive.smallest("Descriptor", F.upper("Type") == "INCHI")})


@query("recompute_derived", f"""
WITH a AS (SELECT "Comp_ID" AS k, count(*) AS n, count(*) FILTER ("Type_symbol" <> 'H') AS nh FROM star_atom GROUP BY 1),
b AS (SELECT DISTINCT "Comp_ID" AS k FROM star_bond WHERE "Aromatic_flag" = 'yes')
SELECT "ID", "ID" AS "BMRB_code", "ID" AS "PDB_code", upper("Type") AS "Type",
  {_DAY} AS "Initial_date", {_DAY} AS "Modified_date",
  CASE WHEN a.n > 0 THEN CAST(a.n AS INTEGER) ELSE "Number_atoms_all" END AS "Number_atoms_all",
  CAST(coalesce(a.nh, 0) AS INTEGER) AS "Number_atoms_nh", CASE WHEN b.k IS NULL THEN 'no' ELSE 'yes' END AS "Aromatic"
FROM star_component LEFT JOIN a ON a.k = "ID" LEFT JOIN b ON b.k = "ID"
""")
def recompute_derived(r: Roles) -> DataFrame:
    return convert.recompute(
        r.star_component, r.star_atom, r.star_bond, _AS_OF, aromatic=derive.exact_flag("Aromatic_flag")
    ).select(
        "ID", "BMRB_code", "PDB_code", "Type", "Initial_date", "Modified_date",
        "Number_atoms_all", "Number_atoms_nh", "Aromatic",
    )


@query("surrogate_ids", """
SELECT id AS "ID", CAST((SELECT max("Sf_ID") FROM star_component) + row_number() OVER (ORDER BY id) AS INTEGER) AS "Sf_ID"
FROM component
""")
def surrogate_ids(r: Roles) -> DataFrame:
    first = ids.next_id((r.star_component, "Sf_ID"))
    return ids.surrogate_ids(r.component.select(F.col("id").alias("ID")), "ID", "Sf_ID", first)


@query("convert_all", """
WITH parent AS (
  SELECT id, pdbx_release_status, number_atoms_all, number_atoms_nh, one_letter_code FROM component
  WHERE pdbx_replaced_by IS NULL AND pdbx_subcomponent_list IS NULL),
numbered AS (SELECT *, CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS sf FROM parent),
a AS (SELECT comp_id, count(*) AS n, count(*) FILTER (type_symbol <> 'H') AS nh FROM atom GROUP BY 1),
b AS (SELECT DISTINCT comp_id FROM bond WHERE upper(pdbx_aromatic_flag) IN ('Y', 'YES')),
d AS (SELECT comp_id, min(descriptor) AS i, count(*) FILTER (type IS NOT NULL) AS nd FROM descriptor
  WHERE upper(type) = 'INCHI' GROUP BY 1)
SELECT id AS "ID", sf AS "Sf_ID", id AS "BMRB_code", id AS "PDB_code",
  coalesce(number_atoms_all, CAST(coalesce(a.n, 0) AS INTEGER)) AS "Number_atoms_all",
  coalesce(number_atoms_nh, CAST(coalesce(a.nh, 0) AS INTEGER)) AS "Number_atoms_nh",
  d.i AS "InChI_code", CASE WHEN b.comp_id IS NULL THEN 'no' ELSE 'yes' END AS "Aromatic"
FROM numbered LEFT JOIN a ON a.comp_id = id LEFT JOIN b ON b.comp_id = id LEFT JOIN d ON d.comp_id = id
""")
def convert_all(r: Roles) -> DataFrame:
    """The whole conversion into an empty STAR side, seen at its parent table."""
    cif = {
        "chem_comp": r.component, "chem_comp_atom": r.atom, "chem_comp_bond": r.bond, "chem_comp_tor": r.torsion,
        "chem_comp_angle": r.angle, "pdbx_chem_comp_descriptor": r.descriptor,
        "pdbx_chem_comp_identifier": r.identifier, "pdbx_chem_comp_feature": r.feature,
    }
    done = convert.convert(cif, schema.empty_tables(r.spark, schema.STAR), _AS_OF)
    return done.tables["Chem_comp"].select(
        "ID", "Sf_ID", "BMRB_code", "PDB_code", "Number_atoms_all", "Number_atoms_nh", "InChI_code", "Aromatic"
    )


@query("bond_ids", """
SELECT comp_id, atom_id_1, atom_id_2, value_order,
  CAST(row_number() OVER (PARTITION BY comp_id ORDER BY atom_id_1 NULLS FIRST, atom_id_2 NULLS FIRST, value_order NULLS FIRST) AS INTEGER) AS id
FROM bond
""")
def bond_ids(r: Roles) -> DataFrame:
    """A bond sequence of its own per component: numbers from 1 in atom order, over all tasks (a
    component with most bonds is numbered by a range shuffle, not one window task)."""
    bonds = r.bond.select("comp_id", "atom_id_1", "atom_id_2", "value_order")
    return ids.number_within(bonds, ["comp_id"], ["atom_id_1", "atom_id_2", "value_order"], "id")
