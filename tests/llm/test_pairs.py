"""Joins, searches and decontamination against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compdict.llm import contamination, jaccard, neighbours
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_jaccard_on_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect())
    assert got == brute.components(rows)


def test_jaccard_on_crowds_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 4)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1000 + i, t) for i, t in enumerate(variants(rng, words, 60, 2))]
    rows += [(2000 + i, t) for i, t in enumerate(variants(rng, words, 40, 5))]
    rows += [(3000 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(rng.randrange(5, 300)))) for i in range(60)]
    rows += [(i, passage) for i in range(30)] + [(7, "Same words"), (5, "same WORDS"), (5, "same words"), (6, "same\twords\n")]
    rows += [(8, ""), (9, None), (10, "  \n"), (None, passage), (None, None), (None, "alone here"), (-3, "one"), (11, "É"), (12, "é")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "x") for k, t in rows], DOCS + ", rec string").repartition(5)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect())
    assert got == brute.components(rows)


def test_jaccard_links_of_a_crowd_stay_few(spark, monkeypatch):
    rng, edges, plain = random.Random(6), [], jaccard.components
    rows = list(enumerate(variants(rng, [f"w{i}" for i in range(120)], 80, 2) + variants(rng, [f"v{i}" for i in range(90)], 80, 4)))

    def counted(df):
        edges.append(df.count())
        return plain(df)

    monkeypatch.setattr(jaccard, "components", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect()) == brute.components(rows)
    # one edge of two components at most, not one of every two near copies
    assert edges[-1] < len(rows)


def test_jaccard_of_nothing(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_neighbours_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").repartition(4)
    got = neighbours.search(rows, rows.filter("vec_id % 20 = 0")).collect()
    data = [(r[0], r[1]) for r in rows.select("vec_id", "embedding").collect()]
    want = brute.nearest(data, [r for r in data if r[0] % 20 == 0], 20)
    hits = sum(1 for r in got if r["vec_id"] in {x[0] for x in want[r["query_id"]]})
    assert hits >= 0.9 * sum(map(len, want.values()))
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert set(by) == set(want) and all(v == sorted(v) and len(v) == 20 for v in by.values())


def test_neighbours_of_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(40)]
    odd = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [float("nan"), 1.0, 1.0]), (280, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(k, v, 1, "c") for k, v in rows + odd + rows[:3]], "vec_id bigint, embedding array<double>, label int, curve string")
    got = neighbours.search(df, df.filter("vec_id % 20 = 0"), k=5).collect()
    want = brute.nearest(rows, [r for r in rows if r[0] % 20 == 0], 5)
    made = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want}
    assert made == {q: [x[0] for x in v] for q, v in want.items()}
    assert {r["query_id"] for r in got} == set(want)
    few = df.filter("vec_id < 3")
    assert neighbours.search(few, few.filter("vec_id = 0")).count() == 2
    assert neighbours.search(df.filter("false"), df).count() == 0


def test_leaks_on_the_tables(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r[0], r[1]) for r in contamination.leaks(docs, items).collect()}
    want = brute.leaks(*([tuple(r) for r in df.collect()] for df in (docs.select("doc_id", "text"), items.select("item_id", "text"))))
    assert got == want


def test_leaks_with_edits_and_odd_rows(spark):
    rng = random.Random(2)
    items = [(i, " ".join(f"i{i}_{k}" for k in range(20 + i))) for i in range(12)] + [(50, None), (51, ""), (52, "too few words"), (53, "i1_1")]
    fill = lambda n: " ".join(f"f{rng.randrange(500)}" for _ in range(n))
    docs = [(i, f"{fill(30)} {t} {fill(25)}") for i, (_, t) in enumerate(items[:12])]
    docs += [(100 + i, f"{fill(9)} {v} {fill(9)}") for i in range(12) for v in variants(rng, items[i][1].split(), 1, 1)]
    docs += [(200, None), (201, ""), (202, "a b"), (203, items[3][1]), (203, items[3][1]), (None, items[4][1]), (204, fill(4000)), (205, " ".join(items[11][1].split()[:12]))]
    df = spark.createDataFrame([(k, t, "en", "s", 1, 2) for k, t in docs], DOCS + ", row int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r[0], r[1]) for r in contamination.leaks(df, bench).collect()}
    assert got == brute.leaks(docs, items)
    kept = contamination.clean(df, bench)
    assert kept.columns == df.columns
    assert {r[0] for r in kept.collect()} == {k for k, _ in docs} - {d for d, _ in got}
    assert contamination.leaks(df, bench.filter("false")).count() == 0
    assert contamination.leaks(df.filter("false"), bench).count() == 0


def test_words_are_hashed_once(monkeypatch):
    """A word asked for again is looked up, not hashed again; sets stay those of plain hashing."""
    from compdict.llm import common, jaccard

    asked = []
    plain = jaccard.xxhash.xxh64_intdigest
    monkeypatch.setattr(jaccard.xxhash, "xxh64_intdigest", lambda w: asked.append(w) or plain(w))
    monkeypatch.setattr(common, "_HELD", [None, None])
    assert len(jaccard.shingle_set("a b A c b a b a c")) == 5
    assert asked == [b"a", b"b", b"c"] and type(common._HELD[1]) is jaccard._Words
