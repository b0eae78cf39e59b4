"""Long lists of near copies: pairs are few, links are all there."""

import random
from collections import Counter

from compdict.llm import jaccard
from tests.llm import brute


def test_long_lists_know_the_links_of_their_leaders(spark, monkeypatch):
    rng, made, plain = random.Random(9), [], jaccard._lists
    passage = [f"p{i}" for i in range(60)]
    # near copies of one passage, each with a text of its own around it: no minimum hash is common to many
    rows = []
    for i in range(150):
        w = list(passage)
        w[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join([f"a{i}", f"b{i}", *w, f"c{i}"])))

    def counted(df, short):
        out = plain(df, short)
        if short is None:
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_lists", counted)
    monkeypatch.setattr(jaccard, "CROWD", 10**6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect()) == brute.components(rows)
    # not every two of the crowd
    assert made == [made[0]] and made[0] < 5 * len(rows)
