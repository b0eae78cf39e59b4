"""Loading a directory, again and again."""

import datetime

import pytest
from pyspark.sql import functions as F

from compdict.operators import merge
from compdict.plans import load
from compdict.sources import snapshot

D = datetime.date
TABLES = ("chem_comp", "chem_comp_atom", "chem_comp_bond")


def component(name, modified="2011-06-04", extra="", atoms=("N", "H1"), initial="1999-07-08"):
    lines = [f"data_{name}", f"_chem_comp.id {name.lower()}", f"_chem_comp.name 'the {name}'"]
    lines += [f"_chem_comp.pdbx_initial_date {initial}", f"_chem_comp.pdbx_modified_date {modified}"]
    if extra:
        lines.append(extra)
    if atoms:
        lines += ["loop_", "_chem_comp_atom.comp_id", "_chem_comp_atom.atom_id", "_chem_comp_atom.pdbx_ordinal"]
        lines += [f"{name} {a} {i + 1}" for i, a in enumerate(atoms)]
    return "\n".join(lines) + "\n"


def write(folder, docs):
    for name, text in docs.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def atoms(loaded):
    return rows(loaded.tables["chem_comp_atom"].select("comp_id", "atom_id", "pdbx_ordinal"))


def settle(spark, loaded, root):
    """Write the result as the next version and read it back."""
    snapshot.write_snapshot(spark, root, loaded.tables)
    return snapshot.read_snapshot(spark, root, TABLES)


def stats(loaded):
    return loaded.stats.first().asDict()


def test_life_of_a_dictionary(spark, tmp_path):
    folder, root = tmp_path / "cif", str(tmp_path / "store")
    write(folder, {
        "a/AAA.cif": component("AAA"),
        "b/bbb.cif": component("BBB", atoms=()),
        "c/CCC.cif": component("CCC", extra="_chem_comp.pdbx_replaced_by XXX"),
        "d/DDD.cif": component("DDD", extra="_chem_comp.pdbx_subcomponent_list 'A B'\n_chem_comp.pdbx_release_status OBS"),
        "e/EEE.cif": component("EEE", modified="?", initial="n/a"),
        "f/FFF.cif": component("FFF") + "loop_\n_chem_comp_bond.comp_id\n_chem_comp_bond.atom_id_1\nFFF\n",
        "g/GGG.cif": component("GGG", extra="_chem_comp.number_atoms_all 12.5"),
        "h/HHH.cif": component("HHH", extra="_chem_comp.colour red"),
        "i/III.cif": "# nothing yet\n",
        "x/FULL/ZZZ.cif": component("ZZZ"),
    })
    first = load.load_directory(spark, str(folder), tables=TABLES)
    assert atoms(first) == [("AAA", "H1", 2), ("AAA", "N", 1)]
    parents = rows(first.tables["chem_comp"].select("id", "name", "pdbx_initial_date", "pdbx_modified_date"))
    assert parents == [
        ("AAA", "the AAA", D(1999, 7, 8), D(2011, 6, 4)), ("BBB", "the BBB", D(1999, 7, 8), D(2011, 6, 4)),
    ]
    assert stats(first) == {
        "total": 9, "new": 2, "updated": 0, "unchanged": 0, "failed": 5, "compound": 1, "obsolete": 1, "gone": 0
    }
    reasons = {r.doc[2:5]: r.reason for r in first.rejects.collect()}
    assert reasons == {
        "FFF": "ragged", "GGG": "bad value chem_comp.number_atoms_all",
        "HHH": "unknown column chem_comp.colour", "III": "empty file",
    }

    stored = settle(spark, first, root)
    again = load.load_directory(spark, str(folder), stored, TABLES)
    assert {t: rows(df) for t, df in again.tables.items()} == {t: rows(df) for t, df in stored.items()}
    assert stats(again)["unchanged"] == 2 and stats(again)["new"] == 0

    # one newer, one newer but broken, one withdrawn, one mended
    write(folder, {
        "a/AAA.cif": component("AAA", modified="2012-01-01", atoms=("N", "C", "O")),
        "b/bbb.cif": component("BBB", modified="2012-01-01", extra="_chem_comp.number_atoms_all many"),
        "f/FFF.cif": component("FFF"),
    })
    second = load.load_directory(spark, str(folder), stored, TABLES)
    assert atoms(second) == [
        ("AAA", "C", 2), ("AAA", "N", 1), ("AAA", "O", 3), ("FFF", "H1", 2), ("FFF", "N", 1),
    ]
    assert rows(second.tables["chem_comp"].select("id", "pdbx_modified_date")) == [
        ("AAA", D(2012, 1, 1)), ("BBB", D(2011, 6, 4)), ("FFF", D(2011, 6, 4)),
    ]
    assert stats(second) == {
        "total": 9, "new": 1, "updated": 1, "unchanged": 0, "failed": 5, "compound": 1, "obsolete": 1, "gone": 0
    }

    stored = settle(spark, second, root)
    write(folder, {"a/AAA.cif": component("AAA", extra="_chem_comp.pdbx_release_status OBS")})
    third = load.load_directory(spark, str(folder), stored, TABLES)
    assert rows(third.gone) == [("AAA",)]
    assert [r[0] for r in atoms(third)] == ["FFF", "FFF"]
    assert stats(third)["gone"] == 1

    (tmp_path / "none").mkdir()
    with pytest.raises(merge.TooManyGone):
        load.load_directory(spark, str(tmp_path / "none"), stored, TABLES)
    assert snapshot.current_version(spark, root) == 2
    assert rows(snapshot.read_snapshot(spark, root, ["chem_comp_atom"], 1)["chem_comp_atom"].select("comp_id")) == [
        ("AAA",), ("AAA",)
    ]


def test_other_component_in_a_file_is_rejected_once_and_for_ever(spark, tmp_path):
    folder, root = tmp_path / "cif", str(tmp_path / "store")
    write(folder, {"AAA.cif": component("AAA"), "BBB.cif": component("BBB")})
    first = load.load_directory(spark, str(folder), tables=TABLES)
    stored = settle(spark, first, root)
    write(folder, {"AAA.cif": component("BBB", modified="2012-01-01")})
    for _ in range(2):
        again = load.load_directory(spark, str(folder), stored, tables=TABLES)
        assert sorted(r["id"] for r in again.tables["chem_comp"].select("id").collect()) == ["AAA", "BBB"]
        assert {r["doc"] for r in again.rejects.collect()} == {"AAA.cif"}
        stored = settle(spark, again, root)


def test_emptied_file_keeps_its_component(spark, tmp_path):
    folder, root = tmp_path / "cif", str(tmp_path / "store")
    write(folder, {f"{c * 3}.cif": component(c * 3) for c in "ABC"})
    stored = settle(spark, load.load_directory(spark, str(folder), tables=TABLES), root)
    write(folder, {"CCC.cif": ""})
    again = load.load_directory(spark, str(folder), stored, tables=TABLES)
    assert sorted(r["id"] for r in again.tables["chem_comp"].select("id").collect()) == ["AAA", "BBB", "CCC"]
    assert stats(again)["total"] == 3
    assert {r["doc"] for r in again.rejects.collect()} == {"CCC.cif"}


def test_rounds_on_the_bucketed_store(spark, tmp_path):
    """Rounds on the store give what a whole rewrite gives; untouched buckets keep their files."""
    from compdict.sources import store

    folder, root = tmp_path / "cif", str(tmp_path / "buckets")
    write(folder, {f"{n}/{n}.cif": component(n) for n in ("AAA", "BBB", "CCC", "DDD", "EEE")})
    first = load.load_into_store(spark, str(folder), root, TABLES)
    assert store.current_version(spark, root) == 2
    assert {t: rows(store.read_table(spark, root, t)) for t in TABLES} == {t: rows(df) for t, df in first.tables.items()}
    before = {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect() if r.path}

    write(folder, {"AAA/AAA.cif": component("AAA", modified="2012-01-01", atoms=("N", "C"))})
    second = load.load_into_store(spark, str(folder), root, TABLES)
    got = {t: rows(store.read_table(spark, root, t)) for t in TABLES}
    assert got == {t: rows(df) for t, df in second.tables.items()}
    aaa = store.read_table(spark, root, "chem_comp_atom").filter("comp_id = 'AAA'").select("atom_id")
    assert rows(aaa) == [("C",), ("N",)]
    after = {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect() if r.path}
    moved = {k for k in before if after.get(k) != before[k]}
    assert moved and {b for _, b in moved} == {spark.range(1).select(store.bucket_of(F.lit("AAA"))).first()[0]}


def test_unchanged_files_are_not_opened(spark, tmp_path):
    """The file manifest decides what is read: a file of the same size and time is not opened."""
    import os

    from compdict.sources import store

    folder, root = tmp_path / "cif", str(tmp_path / "buckets")
    write(folder, {f"{n}/{n}.cif": component(n) for n in ("AAA", "BBB")})
    write(folder, {"e/EMPTY.cif": "", "f/FFF.cif": component("FFF") + "loop_\n_chem_comp_bond.comp_id\n_chem_comp_bond.atom_id_1\nFFF\n"})
    old = 1_000_000_000
    for path in folder.rglob("*.cif"):
        os.utime(path, (old, old))
    first = load.load_into_store(spark, str(folder), root, TABLES)
    assert stats(first)["new"] == 2 and stats(first)["failed"] == 2
    names = rows(store.read_table(spark, root, "chem_comp").select("id", "name"))
    assert names == [("AAA", "the AAA"), ("BBB", "the BBB")]

    # same size, same time, other text: a loader that opened it would see the new name
    path = folder / "AAA" / "AAA.cif"
    path.write_text(component("AAA").replace("the AAA", "THE AAA"))
    os.utime(path, (old, old))
    second = load.load_into_store(spark, str(folder), root, TABLES)
    assert rows(store.read_table(spark, root, "chem_comp").select("id", "name")) == names
    assert stats(second)["unchanged"] == 2 and stats(second)["failed"] == 2
    assert {r.doc[2:5]: r.reason for r in second.rejects.collect()} == {"FFF": "ragged", "EMP": "empty file"}

    # a newer file is opened and replaces its component
    write(folder, {"BBB/BBB.cif": component("BBB", modified="2012-01-01", atoms=("C",))})
    third = load.load_into_store(spark, str(folder), root, TABLES)
    assert stats(third)["updated"] == 1 and stats(third)["unchanged"] == 1
    assert rows(store.read_table(spark, root, "chem_comp_atom").select("comp_id", "atom_id")) == [("AAA", "H1"), ("AAA", "N"), ("BBB", "C")]


def test_duplicate_keys_reject_the_component(spark, tmp_path):
    folder = tmp_path / "cif"
    write(folder, {
        "a/AAA.cif": component("AAA", atoms=("N", "N")),
        "b/BBB.cif": component("BBB") + "loop_\n_chem_comp_bond.comp_id\n_chem_comp_bond.atom_id_1\n_chem_comp_bond.atom_id_2\n"
                     "_chem_comp_bond.value_order\nBBB N XX SING\n",
        "c/CCC.cif": component("CCC"),
    })
    done = load.load_directory(spark, str(folder), tables=TABLES)
    assert [r[0] for r in rows(done.tables["chem_comp"].select("id"))] == ["CCC"]
    reasons = {r.doc[2:5]: r.reason for r in done.rejects.collect()}
    assert reasons == {
        "AAA": "constraint: duplicate chem_comp_atom (comp_id, atom_id)",
        "BBB": "constraint: orphan chem_comp_bond (comp_id, atom_id_2)",
    }
    assert stats(done)["failed"] == 2
