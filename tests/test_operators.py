"""Numbering, checks and merging on hand-made rows, hot groups included."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from compdict.operators import ids, merge, quality, status


def test_number_rows_equals_row_number(spark):
    keys = [f"k{i}" for i in random.Random(1).sample(range(100000), 3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    for parts in (1, 3, 16):
        got = {r.k: r.id for r in ids.number_rows(df, ["k"], start=5, partitions=parts).collect()}
        assert got == {k: i + 5 for i, k in enumerate(sorted(keys))}


def test_number_within_hot_group(spark):
    rows = [("hot", i % 400) for i in range(1200)] + [("a", 3), ("a", 1), (None, 1), (None, 0)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    small = df.withColumn("id", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    large = ids.number_within(df, ["g"], ["v"])
    order = lambda d: sorted((tuple(r) for r in d.select("g", "v", "id").collect()), key=str)
    assert order(small) == order(large)
    assert large.count() == len(rows)


def test_null_keys(spark):
    src = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    held = spark.createDataFrame([("a",), (None,)], "K2 string")
    assert [r.k for r in merge.new_only(src, held, "k", "K2").collect()] == ["b"]


def test_references_with_null_are_not_checked(spark):
    child = spark.createDataFrame([("c", "x", None), ("c", "y", "x"), ("c", "y", "x")], "c string, a1 string, a2 string")
    parent = spark.createDataFrame([("c", "x")], "c string, a string")
    got = quality.reference_violations(child, {"a1": ("c", "a1"), "a2": ("c", "a2")}, parent, ("c", "a"))
    assert [tuple(r) for r in got.collect()] == [("a1", "c", "y", 2)]


def test_replace_is_idempotent_and_keeps_failed(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("B", 2)], "k string, v int")
    new = spark.createDataFrame([("A", 10), ("b", 20), ("c", 30)], "k string, v int")
    changed = spark.createDataFrame([("A",), ("C",)], "_key string")
    once = merge.replace_components(old, new, changed, "k")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(once) == [("A", 10), ("B", 2), ("b", 1), ("c", 30)]
    assert rows(merge.replace_components(once, new, changed, "k")) == rows(once)


def test_changed_since(spark):
    d = lambda s: None if s is None else F.lit(s).cast("date")
    cases = [
        (("2010-01-01", "2011-01-01"), (None, "2011-01-01"), False),
        (("2010-01-01", "2011-01-02"), (None, "2011-01-01"), True),
        (("2010-01-01", "2011-01-01"), (None, None), True),
        (("2010-01-01", None), ("2010-01-01", "1990-01-01"), False),
        (("2010-01-02", None), ("2010-01-01", "2020-01-01"), True),
        (("2010-01-02", None), (None, "2020-01-01"), True),
        ((None, None), (None, None), False),
    ]
    null = F.lit(None).cast("date")
    for new, old, expect in cases:
        cols = [d(x) if x else null for x in (*new, *old)]
        assert spark.range(1).select(status.is_changed(*cols)).first()[0] is expect, (new, old)
