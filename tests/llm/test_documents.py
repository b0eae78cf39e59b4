"""Operators on single documents: library results, held-out accuracy, SQL, odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
import sentencepiece

from compdict.llm import counts, language, licenses, lines, pieces, shards, toxicity
from compdict.llm.queries import MODEL, ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string, score string, shard string"
ODD = ["", None, " ", "\n", "  two  spaces ", "a\n\nb\n", "é中\u0000🙂ñ́", "▁x ▁", "<s>a</s><0x41>", "a" * 3000, " " * 700, "ab " * 3000, "x​­"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, "s", 1, "x", "y", "z") for i, t in enumerate(ODD)] + [(0, "", "en", "s", 0, "", "", "")] * 2 + [(None, "no id", "en", None, 0, "", "", "")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def as_unigram(scores) -> bytes:
    """The model file with its kind set to unigram and new scores for its ordinary pieces."""
    data, out, at, piece = open(MODEL, "rb").read(), bytearray(), 0, 0

    def number(i):
        shift = value = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    def written(v):
        b = bytearray()
        while v > 127:
            b.append(v & 127 | 128)
            v >>= 7
        return bytes([*b, v])

    import struct

    while at < len(data):
        tag, at = number(at)
        size, at = number(at)
        body = data[at : at + size]
        at += size
        if tag >> 3 == 1:
            if piece in scores:
                body = body[: 2 + body[1]] + b"\x15" + struct.pack("<f", scores[piece]) + body[2 + body[1] + 5 :]
            piece += 1
        elif tag >> 3 == 2:
            body = body + b"\x18\x01"
        out += written(tag) + written(len(body)) + body
    return bytes(out)


def test_encoding_is_the_librarys(docs, odd):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (odd, docs.limit(200)):
        want = Counter()
        for k, t in df.select("doc_id", "text").collect():
            ids = lib.encode(t or "")
            want[k, len(ids), tuple(ids), lib.decode(ids)] += 1
        made = pieces.encode(df, MODEL).collect()
        assert Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded"]) for r in made) == want
        assert all(r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() for r in made)
        assert all(r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest() for r in made)
    assert pieces.encode(odd.filter("false"), MODEL).count() == 0


def test_encoding_of_random_texts():
    lib, c, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Codec(MODEL), random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choice("ab  e▁é中\n\t\u0000thingo.🙂ñ́0123") for _ in range(rng.randrange(40)))
        assert c.encode(t) == lib.encode(t) and c.decode(lib.encode(t)) == lib.decode(lib.encode(t))
    odd_ids = [259 + 5, 3 + 0xE4, 3 + 0xB8, 3 + 0x41, 0, 1, 300]
    assert c.decode(odd_ids) == lib.decode(odd_ids)


def test_counts_are_the_unigram_lattices(spark, docs, odd):
    v = pieces.Vocabulary(MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_proto=as_unigram({i: counts.rank_eighths(i) / 8 for i in v.id.values()}))
    for df in (docs.limit(150), odd.filter("text NOT LIKE '%▁%' OR text IS NULL")):
        want = Counter((k, len(lib.encode(t or ""))) for k, t in df.select("doc_id", "text").collect())
        assert Counter((r[0], r[1]) for r in counts.count_tokens(df, MODEL).collect()) == want


def test_toxicity_held_out(spark):
    truth = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic").collect()}
    got = [r for r in QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect() if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.92 * len(got)


def test_toxicity_of_odd_rows(spark, odd):
    model = toxicity.train(["you scum", "kind words here"] * 30, [1, 0] * 30, __import__("numpy").ones(60), rounds=40)
    assert toxicity.score(odd, model).count() == odd.count()
    assert model.score("such scuum") > model.score("such kind words")
    none = toxicity.fit(odd, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert {r["predicted"] for r in toxicity.score(odd, none).collect()} == {0}


def test_toxicity_reads_long_words_to_their_end():
    model = toxicity.train(["you scum", "kind words here"] * 30, [1, 0] * 30, __import__("numpy").ones(60), rounds=40)
    run = "kind-words-here-" * 10
    low, high = (model.score(run + end) for end in ("kind-words" * 20, "you-scum" * 25))
    assert high > low + 0.1
    # a word of two megabytes is scored whole and is not kept
    assert model.score("scum" * 500_000) > 0.5 and not any(len(w) > toxicity.CACHED_LENGTH for w in model._cache)


def test_language_held_out(spark, docs, odd):
    truth = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op4_language"](spark, FOLDER).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in got) >= 0.93 * len(got)
    blank = language.fit(odd.filter("false"))
    assert {r["lang_pred"] for r in language.predict(odd, blank).collect()} == {"und"}
    model = language.train([b"the cat and the dog " * 5, "où est la forêt ".encode() * 5], __import__("numpy").array([0, 1]), ["en", "fr"], rounds=20, lanes=16)
    made = language.predict(odd, model).collect()
    assert len(made) == odd.count() and {r["lang_pred"] for r in made if r["doc_id"] in (0, 1, 2, 3)} == {"und"}
    p = model.probabilities(["the cat", "", "x" * 5000])
    assert p.shape == (3, 2) and abs(p[0].sum() - 1) < 1e-3


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], connect(FOLDER)) == []


def test_licenses_of_odd_rows(spark, odd):
    assert licenses.scan(odd).count() == odd.count()
    rows = [(1, "MIT License, mit license"), (1, "MIT License, mit license"), (None, "x apache LICENSE version 2.0"), (3, "license mit"), (4, None)]
    got = sorted(tuple(r)[:7] for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).fillna({"doc_id": 9}).collect())
    assert got == [(1, 4, 2, 0, 2, "mit", "mit"), (1, 4, 2, 0, 2, "mit", "mit"), (3, 2, 0, None, None, "", ""), (4, 0, 0, None, None, "", ""), (9, 6, 1, 1, 1, "apache", "apache,apache-2.0")]
    assert licenses.scan(odd.filter("false")).count() == 0


def test_licenses_are_looked_up_by_their_rarest_word(spark):
    known = licenses.templates()
    rows = [(i, "license license public software") for i in range(20)] + [(20, "x mit license"), (21, "mit"), (22, "mit licence")]
    vocabulary = sorted({w for *_, words in known for w in words} - licenses.UNINDEXED)
    found = licenses.positions(spark.createDataFrame(rows, "doc_id bigint, text string"), vocabulary, "doc_id", "text").cache()
    places = found.selectExpr("_row", "inline(hits)").select("_row", "at", "word")
    df = {w: 20 if w in ("license", "public") else 3 for w in vocabulary}
    first, others = licenses.postings(known, {w: -n for w, n in df.items()})
    assert first[0] == ("mit", 0) and others[0] == [("license", 1)]
    candidates = licenses.looked_up(places, first).cache()
    # rows with frequent licence words only are not looked at again
    assert candidates.filter("t = 0").count() == 3 and candidates.filter("t <> 0").count() == 0
    assert [r[1:] for r in licenses.verified(candidates, found, others).collect()] == [(0, 1)]
    # with other frequencies the other word is the one looked up
    assert licenses.postings(known, {w: 0.0 if w == "mit" else 1.0 for w in vocabulary})[0][0] == ("license", 1)


def test_shards(spark, docs, odd):
    rows = shards.shard(docs).collect()
    size, count, slots, of = Counter(), Counter(), {}, {}
    for r in rows:
        size[r["shard"]] += r["size"]
        count[r["shard"]] += 1
        slots.setdefault(r["shard"], set()).add(r["slot"])
        of.setdefault(r["text_crc32"], set()).add(r["shard"])
    mean, largest = sum(size.values()) / 24, max(r["size"] for r in rows)
    assert set(size) == set(range(24)) and all(abs(s - mean) <= largest for s in size.values())
    assert all(slots[k] == set(range(count[k])) for k in count)
    assert sum(len(s) > 1 for s in of.values()) <= 3
    made = shards.shard(odd, 3).collect()
    assert len(made) == odd.count() and all(r["text_crc32"] == 0 and r["size"] == 8 for r in made if r["doc_id"] == 1)
    same = shards.shard(spark.createDataFrame([(i, "same text") for i in range(240)], "doc_id bigint, text string")).collect()
    assert {n for n in Counter(r["shard"] for r in same).values()} <= set(range(6, 15))
    assert shards.shard(odd.filter("false")).count() == 0


def test_lines_of_odd_rows(spark, odd):
    rows = [(i, f"own {i}\nshared line\nlast", f"s{i}") for i in range(5)] + [(9, "shared line", "s1"), (None, "shared line\nkept", None), (10, None, "s1"), (11, "", "s2")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, source string, line string, sites string")
    got = {r["doc_id"]: (r["text"], r["_n_removed"]) for r in lines.remove_spread_lines(df).collect()}
    assert got == {**{i: (f"own {i}", 2) for i in range(5)}, 9: ("", 1), None: ("kept", 1), 10: (None, 0), 11: ("", 0)}
    assert lines.remove_spread_lines(odd).count() == odd.count()
