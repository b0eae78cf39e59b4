"""Bucketed store: only touched buckets are rewritten, versions switch in one step."""

import pytest
from pyspark.sql import functions as F

from compdict.sources import store

PARENT = "id string, created date"
ATOM = "comp_id string, ordinal int, atom_id string"


def _files(spark, path):
    p, fs = store._fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def stored(spark, tmp_path):
    parents = [(f"c{i}", None) for i in range(40)]
    atoms = [(f"c{i}", j, f"old{i}.{j}") for i in range(40) for j in range(i % 4)]
    atoms += [("c7", 100 + j, "hot") for j in range(200)]  # one component with most rows
    root = str(tmp_path / "store")
    store.create(spark, root, {
        "parent": (spark.createDataFrame(parents, PARENT), "id"),
        "atom": (spark.createDataFrame(atoms, ATOM), "comp_id"),
        "empty": (spark.createDataFrame([], ATOM), "comp_id"),
    }, buckets=8)
    return root, parents, atoms


def test_round_rewrites_touched_buckets_only(spark, stored):
    root, parents, atoms = stored
    before = {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect() if r.path}
    names = {k: _files(spark, p) for k, p in before.items()}
    changed, gone = ["C3", "c7", "new1"], ["c5"]
    new_atoms = [("C3", 0, "new3"), ("c7", 0, "new7"), ("new1", 0, "n")]
    drop = spark.createDataFrame([(k,) for k in changed + gone], "_key string")
    version, touched = store.apply_round(spark, root, {
        "parent": spark.createDataFrame([("C3", None), ("c7", None), ("new1", None)], PARENT),
        "atom": spark.createDataFrame(new_atoms, ATOM),
    }, drop, buckets=8)
    assert version == 2 and store.current_version(spark, root) == 2
    keys = {k.upper() for k in changed + gone}
    want = [a for a in atoms if a[0].upper() not in keys] + new_atoms
    assert _rows(store.read_table(spark, root, "atom")) == sorted(want)
    assert sorted(r.id for r in store.read_table(spark, root, "parent").collect()) == sorted(
        [p for p, _ in parents if p.upper() not in keys] + ["C3", "c7", "new1"])
    assert store.read_table(spark, root, "empty").count() == 0
    after = {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect() if r.path}
    hit = {r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(store.bucket_of(F.col("k"), 8)).collect()}
    assert set(touched) == hit and len(hit) < 8
    for (table, bucket), path in before.items():
        if bucket not in hit:
            assert after[(table, bucket)] == path and _files(spark, path) == names[(table, bucket)]
        else:
            assert after.get((table, bucket)) != path
    # the first version is still readable as it was
    assert _rows(store.read_table(spark, root, "atom", version=1)) == sorted(atoms)


def test_round_without_changes_touches_nothing(spark, stored):
    root, _, atoms = stored
    before = {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect()}
    version, touched = store.apply_round(spark, root, {}, spark.createDataFrame([], "_key string"), buckets=8)
    assert touched == [] and version == 2
    assert {(r.table, r.bucket): r.path for r in store.manifest(spark, root).collect()} == before
    assert _rows(store.read_table(spark, root, "atom")) == sorted(atoms)


def test_failed_round_leaves_the_version(spark, stored):
    root, _, atoms = stored
    bad = spark.createDataFrame([("c1", "x")], "comp_id string, other string")
    with pytest.raises(Exception):
        store.apply_round(spark, root, {"atom": bad}, spark.createDataFrame([("c1",)], "_key string"), buckets=8)
    assert store.current_version(spark, root) == 1
    assert _rows(store.read_table(spark, root, "atom")) == sorted(atoms)
