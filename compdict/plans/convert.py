"""CIF side to STAR side.

The parent table is built once: new eligible rows and the rows already there, joined
with one aggregation each over descriptors, atoms and bonds.  Rows already there keep
every value they have; only NULLs are filled.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict import schema
from compdict.functions import clean
from compdict.operators import derive, ids, merge, quality

# --- fixed values ------------------------------------------------------------
PROVENANCE = "PDB"
FLAGS = {
    "Ambiguous_flag": "pdbx_ambiguous_flag",
    "Mon_nstd_flag": "mon_nstd_flag",
    "Model_coordinates_missing_flag": "pdbx_model_coordinates_missing_flag",
    "Ideal_coordinates_missing_flag": "pdbx_ideal_coordinates_missing_flag",
}
CHILDREN = {
    "Chem_comp_descriptor": "pdbx_chem_comp_descriptor",
    "Chem_comp_identifier": "pdbx_chem_comp_identifier",
    "PDBX_chem_comp_feature": "pdbx_chem_comp_feature",
    "Chem_comp_atom": "chem_comp_atom",
    "Chem_comp_bond": "chem_comp_bond",
    "Chem_comp_tor": "chem_comp_tor",
    "Chem_comp_angle": "chem_comp_angle",
}
PARENT_ID_FILLED = (
    "Chem_comp_descriptor", "Chem_comp_identifier", "PDBX_chem_comp_feature", "Chem_comp_atom", "Chem_comp_bond",
)


def mapped(source: DataFrame, table: str, given: dict[str, Column] | None = None) -> DataFrame:
    """The columns of a STAR-side table from a CIF-side one.

    A column takes what ``given`` says, else the source column of the same name in
    any case, else that name with ``pdbx_`` in front, else NULL.  Text meant for a
    typed column is cast; ``map_rejects`` lists what does not fit.
    """
    given = given or {}
    types = {f.name.lower(): f.dataType for f in source.schema.fields}
    out = []
    for field in schema.STAR[table].fields:
        name = field.name.lower()
        found = next((c for c in (name, f"pdbx_{name}") if c in types), None)
        if field.name in given:
            col = given[field.name].cast(field.dataType)
        elif found is None:
            col = F.lit(None).cast(field.dataType)
        elif types[found] == field.dataType:
            col = F.col(found)
        else:
            col = clean.typed(found, field.dataType)
        out.append(col.alias(field.name))
    return source.select(*out)


def eligible(components: DataFrame) -> DataFrame:
    """Neither replaced nor compound."""
    return components.filter("pdbx_replaced_by IS NULL AND pdbx_subcomponent_list IS NULL")


def map_component(components: DataFrame, as_of: date, framecode_prefix: str = "chem_comp") -> DataFrame:
    """Parent rows; both dates are the day of the conversion."""
    given = {star: clean.yes_no(cif) for star, cif in FLAGS.items()}
    given.update(
        Name=F.coalesce("name", "id"),
        Type=F.upper("type"),
        Initial_date=F.lit(as_of),
        Modified_date=F.lit(as_of),
        Entry_ID=F.lit(schema.NO_ACCESSION),
        Provenance=F.lit(PROVENANCE),
        Sf_category=F.lit("chem_comp"),
        Sf_framecode=F.concat(F.lit(framecode_prefix), F.col("id")),
        Subcomponent_list=F.lit(None),
    )
    return mapped(eligible(components), "Chem_comp", given)


def map_child(source: DataFrame, table: str) -> DataFrame:
    """Child rows of one table; bonds take their ordinal as ID."""
    given = {"Entry_ID": F.lit(schema.NO_ACCESSION)}
    if table == "Chem_comp_bond":
        given["ID"] = F.col("pdbx_ordinal")
    return mapped(source, table, given)


def map_rejects(source: DataFrame, table: str) -> DataFrame:
    """``(comp_id, column, value)`` of source text that does not fit the typed target column."""
    types = {f.name.lower(): f.dataType for f in source.schema.fields}
    wrong = {}
    for field in schema.STAR[table].fields:
        name = field.name.lower()
        found = next((c for c in (name, f"pdbx_{name}") if c in types), None)
        if found is not None and types[found] != field.dataType:
            wrong[found] = field.dataType
    if not wrong:
        return source.sparkSession.createDataFrame([], "comp_id string, column string, value string")
    return quality.cast_rejects(source, wrong, ["comp_id"])


def missing_rejects(new: DataFrame, table: str) -> DataFrame:
    """``(comp_id, column, value)`` of mapped rows without a required value; the value is NULL."""
    return quality.not_null_violations(new, schema.NOT_NULL[table], ["Comp_ID"]).select(
        F.col("Comp_ID").alias("comp_id"), "column", F.lit(None).cast("string").alias("value")
    )


def keyless_rejects(source: DataFrame) -> DataFrame:
    """``(comp_id, column, value)`` of source rows that name no component."""
    null = F.lit(None).cast("string")
    return source.filter("comp_id IS NULL").select(
        null.alias("comp_id"), F.lit("comp_id").alias("column"), null.alias("value")
    )


def fill_codes(components: DataFrame) -> DataFrame:
    return merge.fill_nulls(components, {"BMRB_code": "ID", "PDB_code": "ID"})


def fill_atom_codes(atoms: DataFrame) -> DataFrame:
    return merge.fill_nulls(atoms, {"BMRB_code": "Atom_ID", "PDB_atom_ID": "Atom_ID"})


def component_facts(aromatic: derive.Fact) -> dict[str, dict[str, derive.Fact]]:
    """Parent columns filled from each child table."""
    return {
        "Chem_comp_descriptor": {"InChI_code": derive.smallest("Descriptor", F.upper("Type") == "INCHI")},
        "Chem_comp_atom": {
            "Number_atoms_all": derive.row_count(),
            "Number_atoms_nh": derive.count_not_equal("Type_symbol", "H"),
        },
        "Chem_comp_bond": {"Aromatic": aromatic},
    }


def fill_facts(components: DataFrame, children: dict[str, DataFrame], aromatic: derive.Fact) -> DataFrame:
    for table, facts in component_facts(aromatic).items():
        components = derive.derive(components, children[table], "ID", "Comp_ID", facts)
    return components


def recompute(
    components: DataFrame, atoms: DataFrame, bonds: DataFrame, as_of: date | None = None,
    aromatic: derive.Fact | None = None,
) -> DataFrame:
    """Set derived values of refreshed components, kept values or not.

    Codes always follow the ID and the type is upper case; the atom count stays where
    there are no atoms; with ``as_of`` both dates start anew.  The aromatic rule is that of
    ``convert`` unless another is given.
    """
    out = derive.derive(
        components, atoms, "ID", "Comp_ID",
        {
            "Number_atoms_all": derive.Fact(F.count(F.lit(1)).cast("int"), 0, only_positive=True),
            "Number_atoms_nh": derive.count_not_equal("Type_symbol", "H"),
        },
        overwrite=True,
    )
    out = derive.derive(out, bonds, "ID", "Comp_ID", {"Aromatic": aromatic or derive.any_flag("Aromatic_flag")}, overwrite=True)
    changes = {"BMRB_code": F.col("ID"), "PDB_code": F.col("ID"), "Type": F.upper("Type")}
    if as_of is not None:
        changes.update(Initial_date=F.lit(as_of), Modified_date=F.lit(as_of))
    return out.withColumns(changes)


def normalise_copy(df: DataFrame) -> DataFrame:
    """Strip all text columns, turn blanks into NULL and spell out columns ending in ``_flag``."""
    changes = {}
    for name, kind in df.dtypes:
        if kind == "string":
            value = clean.blank_to_null(name)
            changes[name] = clean.normalise_flag(value) if name.endswith("_flag") else value
    return df.withColumns(changes)


@dataclass
class Converted:
    tables: dict[str, DataFrame]
    rejects: DataFrame
    orphans: DataFrame


def convert(
    cif: dict[str, DataFrame],
    star: dict[str, DataFrame],
    as_of: date,
    aromatic: derive.Fact | None = None,
    framecode_prefix: str = "chem_comp",
    least_id: int = 1,
) -> Converted:
    """Add components the STAR side does not hold yet; those it holds are never touched but for NULLs.

    A new child row that names no component or lacks a required value is a reject with a
    NULL value and is not stored; text that does not fit its column is a reject with that text.
    New saveframe IDs start at ``least_id`` at least, so numbers once given need not come back.
    """
    aromatic = aromatic or derive.any_flag("Aromatic_flag")
    old = star["Chem_comp"]
    fresh = map_component(
        merge.new_only(cif["chem_comp"], old, "id", "ID"), as_of, framecode_prefix
    )
    first = max(ids.next_id((old, "Sf_ID"), (star["Entity"], "Sf_ID")), least_id)
    components = old.unionByName(ids.surrogate_ids(fresh, "ID", "Sf_ID", first).select(*old.columns))
    parents = merge.keys_of(components, "ID")

    tables, rejects, orphans = {}, [], []
    for table, source in CHILDREN.items():
        incoming = merge.new_only(cif[source], star[table], "comp_id", "Comp_ID")
        new = map_child(incoming, table)
        if table == "Chem_comp_angle":
            new = ids.number_within(
                new.drop("ID"), ["Comp_ID"], ["Atom_ID_1", "Atom_ID_2", "Atom_ID_3"], "ID"
            ).select(*star[table].columns)
        rejects += [
            found.select(F.lit(table).alias("table"), "comp_id", "column", "value")
            for found in (map_rejects(incoming, table), missing_rejects(new, table), keyless_rejects(cif[source]))
        ]
        new = new.dropna(subset=list(schema.NOT_NULL[table]))
        orphans.append(
            merge.not_in(new, parents, "Comp_ID").groupBy("Comp_ID").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(table).alias("table"), "Comp_ID", "n")
        )
        tables[table] = star[table].unionByName(merge.only_in(new, parents, "Comp_ID"))

    tables["Chem_comp_atom"] = fill_atom_codes(tables["Chem_comp_atom"])
    tables["Chem_comp"] = fill_facts(fill_codes(components), tables, aromatic).select(*old.columns)
    for table in PARENT_ID_FILLED:
        tables[table] = derive.backfill(
            tables[table], components, "Comp_ID", "ID", {"Sf_ID": "Sf_ID"}
        ).select(*star[table].columns)
    return Converted(tables, _union(rejects), _union(orphans))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
