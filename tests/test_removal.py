"""Removal along a reference graph, level by level."""

import re

import pytest

from compdict import schema
from compdict.operators import merge

REFS = [
    ("atom", ("comp",), "comp", ("id",)),
    ("note", ("owner", "atom"), "atom", ("comp", "name")),  # reaches components only through atoms
    ("remark", ("note_id",), "note", ("id",)),
]


def test_rows_leave_level_by_level(spark):
    tables = {
        "comp": spark.createDataFrame([("a",), ("B",), (None,)], "id string"),
        "atom": spark.createDataFrame([("A", "x"), ("b", "y"), (None, "z")], "comp string, name string"),
        "note": spark.createDataFrame([(1, "a", "X"), (2, "B", "y"), (3, None, "x"), (4, "a", "q")], "id int, owner string, atom string"),
        "remark": spark.createDataFrame([(1, "r1"), (2, "r2"), (None, "r3")], "note_id int, text string"),
        "other": spark.createDataFrame([("a",)], "comp string"),
    }
    gone = spark.createDataFrame([("A",)], "_key string")
    left = {t: sorted((tuple(r) for r in df.collect()), key=str) for t, df in merge.remove_along(tables, REFS, "comp", "id", gone).items()}
    assert left["comp"] == sorted([("B",), (None,)], key=str)
    assert left["atom"] == sorted([("b", "y"), (None, "z")], key=str)
    # note 1 refers to atom (a, x), removed with component a; note 4 refers to no atom and stays
    assert left["note"] == sorted([(2, "B", "y"), (3, None, "x"), (4, "a", "q")], key=str)
    assert left["remark"] == sorted([(2, "r2"), (None, "r3")], key=str)
    assert left["other"] == [("a",)]


def test_removed_keys_are_hashed_and_a_reference_named_twice_is_walked_once(spark):
    tables = {
        "comp": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string"),
        "atom": spark.createDataFrame([("A", "x"), ("A", "x"), ("b", "y"), (None, "z")], "comp string, name string"),
    }
    gone = spark.createDataFrame([("A",), ("A",), (None,)], "_key string")
    left = merge.remove_along(tables, [REFS[0], REFS[0]], "comp", "id", gone)
    plan = left["atom"]._jdf.queryExecution().executedPlan().toString()
    assert sorted((tuple(r) for r in left["comp"].collect()), key=str) == sorted([("b",), (None,)], key=str)
    assert sorted((tuple(r) for r in left["atom"].collect()), key=str) == sorted([("b", "y"), (None, "z")], key=str)
    # atoms without the removed components, and those components found by the gone keys
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_components_stream_by_hashed_entities(spark):
    from compdict.plans import entity

    row = {f.name: None for f in schema.STAR["Chem_comp"].fields}
    components = spark.createDataFrame([{**row, "ID": k, "Sf_ID": 4} for k in ("b", "a")], schema.STAR["Chem_comp"])
    built = entity.build_entities(components)
    assert sorted((r["Nonpolymer_comp_ID"], r["Sf_ID"]) for r in built["Entity"].collect()) == [("a", 5), ("b", 6)]
    assert sorted((r["Comp_ID"], r["Sf_ID"]) for r in built["Entity_comp_index"].collect()) == [("a", 5), ("b", 6)]
    plan = built["Entity_comp_index"]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ShuffledHashJoin \[ID#\w+\], \[_comp#\w+\], Inner, BuildRight", plan)


def test_a_cycle_is_refused(spark):
    tables = {n: spark.createDataFrame([("a",)], "id string") for n in ("r", "p", "q")}
    with pytest.raises(ValueError):
        merge.remove_along(tables, [("p", ("id",), "q", ("id",)), ("q", ("id",), "p", ("id",))], "r", "id",
                           spark.createDataFrame([("A",)], "_key string"))


def test_constraint_closure_takes_whole_components_until_nothing_changes(spark):
    from compdict.operators import quality

    tables = {
        "comp": spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "id string"),
        "atom": spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "y"), ("C", "z"), ("D", None)], "comp string, name string"),
        # A and then C lean on other components: A on B, C on A
        "link": spark.createDataFrame([("A", "B"), ("C", "A"), ("D", None)], "comp string, other string"),
    }
    component = {"comp": "id", "atom": "comp", "link": "comp"}
    unique = {"atom": [("comp", "name")]}
    refs = [("atom", ("comp",), "comp", ("id",)), ("link", ("other",), "comp", ("id",))]
    rejected, left = quality.constraint_closure(tables, component, unique, {"atom": ("name",)}, refs)
    got = sorted(tuple(r) for r in rejected.collect())
    assert got == [("A", "orphan link (other)"), ("B", "duplicate atom (comp, name)"), ("C", "orphan link (other)"), ("D", "null atom.name")]
    assert left["comp"].count() == 0


def test_cascade_hashes_the_keys_and_sorts_nothing(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("C", 4)], "comp string, n int")
    parent = spark.createDataFrame([("a",), ("a",), ("C",), (None,)], "id string")
    left = merge.cascade(child, parent, "comp", "id")
    assert sorted(left.collect(), key=str) == sorted([("a", 1), ("a", 1), (None, 3), ("C", 4)], key=str)
    plan = left._jdf.queryExecution().executedPlan().toString()
    # partitions stay as dealt: small ones are not put together in one task
    assert "ShuffledHashJoin" in plan and "REPARTITION_BY_NUM" in plan and "Sort" not in plan
