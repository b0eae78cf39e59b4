"""Keys of a round and references of a table are worked out once."""

from pyspark.sql import functions as F

from compdict.operators import quality
from compdict.queries import QUERIES, components
from compdict.sources import store


def _counted(spark, df):
    """The rows of ``df`` and how often they were made."""
    seen = spark.sparkContext.accumulator(0)

    def see(key):
        seen.add(1)
        return key

    return df.select(F.udf(see, "string").asNondeterministic()("_key").alias("_key")), seen


def test_keys_of_a_round_are_made_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"c{i}", i) for i in range(20)], "id string, n int")
    root = str(tmp_path / "store")
    store.create(spark, root, {"a": (rows, "id"), "b": (rows, "id")}, buckets=4)
    drop, seen = _counted(spark, spark.createDataFrame([("C3",), ("C4",), ("C5",)], "_key string"))
    store.apply_round(spark, root, {"a": spark.createDataFrame([("c3", 99)], "id string, n int")}, drop, buckets=4)
    assert seen.value == 3
    assert sorted(tuple(r) for r in store.read_table(spark, root, "a").collect()) == sorted(
        [("c3", 99)] + [(f"c{i}", i) for i in range(20) if i not in (3, 4, 5)])
    assert store.read_table(spark, root, "b").count() == 17


def test_remove_gone_makes_the_gone_keys_once(spark, monkeypatch):
    plain, made = components.gone, []

    def gone(r):
        keys, seen = _counted(spark, plain(r))
        made.append((plain(r).count(), seen))
        return keys

    monkeypatch.setattr(components, "gone", gone)
    assert QUERIES["remove_gone"](spark, "/root/testdata/sf0.001").count() > 0
    [(n, seen)] = made
    assert n > 0 and seen.value == n


def test_references_are_counted_in_the_shuffle_of_their_join(spark):
    parent = spark.createDataFrame([("A", "x"), ("A", "y"), (None, "x")], "comp string, name string")
    child = spark.createDataFrame(
        [("A", "x", "q"), ("A", "q", "q"), ("A", None, "y"), ("B", "x", None), (None, "x", "y")], "comp string, one string, two string")
    refs = {"one": ("comp", "one"), "two": ("comp", "two")}
    found = quality.reference_violations(child, refs, parent, ("comp", "name"))
    assert sorted(tuple(r) for r in found.collect()) == [("one", "A", "q", 1), ("one", "B", "x", 1), ("two", "A", "q", 2)]
    assert "hashpartitioning(reference" not in found._jdf.queryExecution().executedPlan().toString()
