"""CIF side to STAR side and on to entities."""

import datetime

import pytest
from pyspark.sql import functions as F

from compdict import schema
from compdict.operators import derive, merge
from compdict.plans import convert, entity, publish, refresh

DAY = datetime.date(2021, 3, 4)


def make(spark, table, rows):
    layout = schema.CIF[table]
    return spark.createDataFrame([tuple(r.get(c) for c in layout.names) for r in rows], layout)


@pytest.fixture
def cif_side(spark):
    tables = schema.empty_tables(spark, schema.CIF)
    tables["chem_comp"] = make(spark, "chem_comp", [
        {"id": "ALA", "name": "ALANINE", "type": "l-peptide linking", "pdbx_ambiguous_flag": "y", "three_letter_code": "ALA"},
        {"id": "HOH", "name": "Water", "type": "non-polymer"},
        {"id": "NUL", "number_atoms_all": 9},
        {"id": "OLD", "pdbx_replaced_by": "ALA"},
        {"id": "TWO", "pdbx_subcomponent_list": "A B"},
    ])
    tables["chem_comp_atom"] = make(spark, "chem_comp_atom", [
        {"comp_id": "ALA", "atom_id": "N", "type_symbol": "N", "pdbx_align": "1"},
        {"comp_id": "ALA", "atom_id": "D", "type_symbol": "D", "pdbx_align": "x"},
        {"comp_id": "ALA", "atom_id": "H", "type_symbol": "H"},
        {"comp_id": "ALA", "atom_id": "Q"},
        {"comp_id": "OLD", "atom_id": "N", "type_symbol": "N"},
    ])
    tables["chem_comp_bond"] = make(spark, "chem_comp_bond", [
        {"comp_id": "ALA", "atom_id_1": "N", "atom_id_2": "H", "pdbx_ordinal": 1, "pdbx_aromatic_flag": "N"},
        {"comp_id": "ALA", "atom_id_1": "N", "atom_id_2": "D", "pdbx_ordinal": 2, "pdbx_aromatic_flag": "Y"},
    ])
    tables["pdbx_chem_comp_descriptor"] = make(spark, "pdbx_chem_comp_descriptor", [
        {"comp_id": "ALA", "type": "InChI", "descriptor": "b"}, {"comp_id": "ALA", "type": "INCHI", "descriptor": "a"},
        {"comp_id": "ALA", "type": "InChIKey", "descriptor": "A"}, {"comp_id": "HOH", "type": "SMILES", "descriptor": "O"},
    ])
    tables["chem_comp_angle"] = make(spark, "chem_comp_angle", [
        {"comp_id": "ALA", "atom_id_1": "N", "atom_id_2": "D", "atom_id_3": "H"},
        {"comp_id": "ALA", "atom_id_1": "D", "atom_id_2": "N", "atom_id_3": "H"},
    ])
    return tables


def test_convert(spark, cif_side):
    star = schema.empty_tables(spark, schema.STAR)
    done = convert.convert(cif_side, star, DAY)
    comp = {r.ID: r for r in done.tables["Chem_comp"].collect()}
    assert set(comp) == {"ALA", "HOH", "NUL"}
    ala, water, nul = comp["ALA"], comp["HOH"], comp["NUL"]
    assert (ala.Name, ala.Type, ala.Ambiguous_flag, ala.Mon_nstd_flag) == ("ALANINE", "L-PEPTIDE LINKING", "yes", "no")
    assert (ala.Number_atoms_all, ala.Number_atoms_nh, ala.InChI_code, ala.Aromatic) == (4, 2, "a", "yes")
    assert (ala.BMRB_code, ala.PDB_code, ala.Sf_framecode, ala.Entry_ID) == ("ALA", "ALA", "chem_compALA", "NEED_ACC_NO")
    assert (ala.Initial_date, ala.Modified_date, ala.Provenance) == (DAY, DAY, "PDB")
    assert (water.Number_atoms_all, water.Number_atoms_nh, water.InChI_code, water.Aromatic) == (0, 0, None, "no")
    assert (nul.Name, nul.Number_atoms_all, nul.Sf_ID) == ("NUL", 9, 3)
    assert {r.ID: r.Sf_ID for r in comp.values()} == {"ALA": 1, "HOH": 2, "NUL": 3}
    atoms = {r.Atom_ID: r for r in done.tables["Chem_comp_atom"].collect()}
    assert len(atoms) == 4 and atoms["N"].Align == 1 and atoms["N"].Sf_ID == 1 and atoms["Q"].BMRB_code == "Q"
    assert [(r.Atom_ID_1, r.ID) for r in done.tables["Chem_comp_angle"].orderBy("ID").collect()] == [("D", 1), ("N", 2)]
    assert [tuple(r) for r in done.rejects.collect()] == [("Chem_comp_atom", "ALA", "pdbx_align", "x")]
    assert [tuple(r) for r in done.orphans.collect()] == [("Chem_comp_atom", "OLD", 1)]

    # a second run changes nothing, whatever was edited locally
    again = convert.convert(cif_side, done.tables | {"Entity": star["Entity"]}, datetime.date(2022, 1, 1))
    for name, df in done.tables.items():
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, again.tables[name].collect()), key=str), name

    written = convert.convert(cif_side, star, DAY, aromatic=derive.exact_flag("Aromatic_flag"), framecode_prefix="chem_comp_")
    row = written.tables["Chem_comp"].filter("ID = 'ALA'").first()
    assert (row.Aromatic, row.Sf_framecode) == ("no", "chem_comp_ALA")


def test_entities(spark, cif_side):
    comps = convert.convert(cif_side, schema.empty_tables(spark, schema.STAR), DAY).tables["Chem_comp"]
    out = entity.build_entities(comps)
    e = {r.Nonpolymer_comp_ID: r for r in out["Entity"].collect()}
    assert (e["HOH"].Type, e["ALA"].Type, e["ALA"].Name, e["ALA"].Sf_framecode) == ("water", "non-polymer", "ALANINE", "entity_ALA")
    assert sorted(r.Sf_ID for r in e.values()) == [4, 5, 6]
    names = sorted((r.Sf_ID, r.Naming_system, r.Name) for r in out["Entity_systematic_name"].collect())
    assert names[:2] == [(4, "BMRB", "ALANINE"), (4, "Three letter code", "ALA")]
    assert names[3] == (5, "Three letter code", "HOH")
    index = {r.Comp_ID: r for r in out["Entity_comp_index"].collect()}
    assert (index["ALA"].Auth_seq_ID, index["ALA"].Entity_ID, index["ALA"].Comp_label) == ("1", 1, "chem_comp_ALA")
    again = entity.build_entities(comps, out["Entity"])
    assert sorted(map(tuple, again["Entity"].collect()), key=str) == sorted(map(tuple, out["Entity"].collect()), key=str)


def test_refresh(spark):
    d = datetime.date
    up = spark.createDataFrame([
        ("n", d(2000, 1, 1), None), ("r", None, d(2012, 1, 1)), ("c", None, d(2012, 1, 1)), ("u", None, d(2010, 1, 1)),
        ("z", None, None),
    ], "id string, created date, modified date")
    here = spark.createDataFrame([
        ("r", d(2011, 1, 1), d(2011, 1, 1)), ("c", d(2010, 1, 1), d(2011, 1, 1)), ("u", d(2010, 1, 1), d(2011, 1, 1)),
        ("z", None, None),
    ], "id string, created date, modified date")
    got = {r.id: r.action for r in merge.refresh_action(up, here).collect()}
    assert got == {"n": "NEW", "r": "REPLACE", "c": "CONFLICT", "u": "UNCHANGED", "z": "UNCHANGED"}


def test_publish(spark, tmp_path):
    parents = spark.createDataFrame([("B", "chem_compB", "it's"), ("A", "chem_compA", None)], "ID string, Sf_framecode string, Name string")
    bonds = spark.createDataFrame([("A", 2, "x y"), ("A", 1, "N")], "Comp_ID string, ID int, Atom_ID_1 string")
    lines = publish.saveframe_lines(
        parents, "ID", "Sf_framecode", "Chem_comp", {"Chem_comp_bond": (bonds, "Comp_ID", "ID")}, ["ID", "Name"]
    )
    publish.write_saveframes(lines, str(tmp_path / "text"), 3)
    text = "".join(p.read_text() for p in sorted((tmp_path / "text").glob("part-*")))
    assert [w.strip() for w in text.splitlines()] == [
        "save_chem_compA", "_Chem_comp.ID  A", "_Chem_comp.Name  .", "loop_", "_Chem_comp_bond.ID",
        "_Chem_comp_bond.Atom_ID_1", "1 N", "2 'x y'", "stop_", "save_",
        "save_chem_compB", "_Chem_comp.ID  B", "_Chem_comp.Name  it's", "save_",
    ]
    publish.public_dump(parents, str(tmp_path / "csv"), "ID", ["ID", "Name"], 2, "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted(r.ID for r in back.collect()) == ["A", "B"]


def test_convert_rejects_rows_without_required_values(spark, cif_side):
    cif_side["chem_comp_bond"] = make(spark, "chem_comp_bond", [
        {"comp_id": "ALA", "atom_id_1": "N", "atom_id_2": "H", "pdbx_ordinal": 1},
        {"comp_id": "ALA", "atom_id_1": "N", "atom_id_2": "D"}, {"atom_id_1": "N", "atom_id_2": "D", "pdbx_ordinal": 3},
    ])
    done = convert.convert(cif_side, schema.empty_tables(spark, schema.STAR), DAY)
    assert [r.ID for r in done.tables["Chem_comp_bond"].collect()] == [1]
    assert sorted(map(tuple, done.rejects.filter("table = 'Chem_comp_bond'").collect()), key=str) == sorted(
        [("Chem_comp_bond", "ALA", "ID", None), ("Chem_comp_bond", None, "comp_id", None)], key=str
    )


@pytest.fixture
def star_side(spark, cif_side):
    star = schema.empty_tables(spark, schema.STAR)
    star |= convert.convert(cif_side, star, DAY).tables
    star |= entity.build_entities(star["Chem_comp"])
    # stored, as between two runs
    return {table: df.coalesce(1).checkpoint() for table, df in star.items()}


def test_remove_components_from_all_tables(spark, star_side):
    left = refresh.remove_components(star_side, spark.createDataFrame([("ALA",)], "_key string"))
    ids = lambda t, c: {r[0] for r in left[t].select(c).collect()}
    assert ids("Chem_comp", "ID") == ids("Entity", "Nonpolymer_comp_ID") == ids("Entity_comp_index", "Comp_ID") == {"HOH", "NUL"}
    assert ids("Chem_comp_atom", "Comp_ID") == ids("Chem_comp_angle", "Comp_ID") == set()
    frames = ids("Entity", "Sf_ID")
    for names in refresh.BY_ENTITY:
        assert ids(names, "Sf_ID") == frames, names


def test_apply_refresh(spark, cif_side, star_side):
    cif_side["chem_comp_atom"] = make(spark, "chem_comp_atom", [
        {"comp_id": "ALA", "atom_id": "N2", "type_symbol": "N"}, {"comp_id": "HOH", "atom_id": "O", "type_symbol": "O"},
    ])
    actions = spark.createDataFrame(
        [("ALA", "REPLACE"), ("HOH", "CONFLICT"), ("NUL", "UNCHANGED"), ("OLD", "NEW")], "id string, action string"
    )
    later = datetime.date(2022, 5, 6)
    done = refresh.apply_refresh(cif_side, star_side, actions, later)
    comp = {r.ID: r for r in done.tables["Chem_comp"].collect()}
    assert set(comp) == {"ALA", "HOH", "NUL"}
    ala = comp["ALA"]
    assert (ala.Number_atoms_all, ala.Number_atoms_nh, ala.Aromatic, ala.Modified_date, ala.BMRB_code) == (1, 1, "yes", later, "ALA")
    before = {r.ID: r for r in star_side["Chem_comp"].collect()}
    assert comp["HOH"] == before["HOH"] and comp["NUL"] == before["NUL"]
    assert [(r.Comp_ID, r.Atom_ID, r.PDB_atom_ID) for r in done.tables["Chem_comp_atom"].collect()] == [("ALA", "N2", "N2")]
    assert [r.Aromatic_flag for r in done.tables["Chem_comp_bond"].orderBy("ID").collect()] == ["no", "yes"]
    assert [r.id for r in done.conflicts.collect()] == ["HOH"]
    assert {r[0] for r in done.tables["Entity"].select("Nonpolymer_comp_ID").collect()} == {"HOH", "NUL"}


def test_star_text_keeps_semicolons_inside(spark):
    from compdict.functions import clean

    got = spark.createDataFrame([("a\n;b",)], "v string").select(clean.star_value("v")).first()[0]
    assert got == "\n;a\n ;b\n;"


def test_refresh_leaves_conflict_rows_with_nulls_as_stored(spark, cif_side, star_side):
    """A conflict row with NULL facts and codes comes back byte for byte; fills reach refreshed rows only."""
    nulled = ("Number_atoms_all", "Number_atoms_nh", "Aromatic", "Three_letter_code", "BMRB_code", "Sf_ID")
    comp = star_side["Chem_comp"]
    comp = comp.select(*[F.when(F.col("ID") == "HOH", F.lit(None).cast(t)).otherwise(F.col(c)).alias(c) if c in nulled else F.col(c)
                         for c, t in comp.dtypes])
    star = dict(star_side, Chem_comp=comp.coalesce(1).checkpoint())
    atoms = star["Chem_comp_atom"]
    star["Chem_comp_atom"] = atoms.withColumn("PDB_atom_ID", F.when(F.col("Comp_ID") == "HOH", F.lit(None)).otherwise(F.col("PDB_atom_ID")))
    actions = spark.createDataFrame([("ALA", "REPLACE"), ("HOH", "CONFLICT")], "id string, action string")
    done = refresh.apply_refresh(cif_side, star, actions, datetime.date(2022, 5, 6))
    before = {r.ID: r for r in star["Chem_comp"].collect()}
    after = {r.ID: r for r in done.tables["Chem_comp"].collect()}
    assert after["HOH"] == before["HOH"]
    hoh = lambda d: sorted((tuple(r) for r in d["Chem_comp_atom"].filter("Comp_ID = 'HOH'").collect()), key=str)
    assert hoh(done.tables) == hoh(star)


def test_refresh_keeps_replaced_ids_and_never_gives_a_number_again(spark, cif_side, star_side):
    before = {r.ID: r.Sf_ID for r in star_side["Chem_comp"].collect()}
    top = max([v for v in before.values() if v is not None] + [r.Sf_ID for r in star_side["Entity"].collect() if r.Sf_ID is not None])
    actions = spark.createDataFrame([("ALA", "REPLACE"), ("OLD", "NEW")], "id string, action string")
    done = refresh.apply_refresh(cif_side, star_side, actions, datetime.date(2022, 5, 6))
    after = {r.ID: r.Sf_ID for r in done.tables["Chem_comp"].collect()}
    assert after["ALA"] == before["ALA"]
    assert all(v > top for k, v in after.items() if k not in before)
    ala = {r.Sf_ID for r in done.tables["Chem_comp_atom"].filter("Comp_ID = 'ALA'").collect()}
    assert ala <= {before["ALA"]}
