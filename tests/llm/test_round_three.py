"""Conversation repair, URL verdicts and ranked search: plain versions, SQL and odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from compdict.llm import conversations, search, urls
from compdict.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"
CONV = "conv_id bigint, turn bigint, role string, text string"


def _repaired(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in df.collect()}


def test_repair_on_the_table(spark):
    got = QUERIES["op11_conversation_repair"](spark, FOLDER)
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _repaired(got) == brute.repair(rows)


def odd_conversations():
    rows = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello"), (1, 3, "user", "Hi."),
        (2, None, "user", None), (2, 5, None, "x."), (2, 9, "tool", "out."), (2, 9, "tool", "out."),
        (3, 0, "assistant", "a."), (3, 1, "assistant", "b."), (3, 2, "system", "c."),
        (None, 1, "user", "no id."), (None, 2, "assistant", "fine."),
        (4, 0, "user", "é" * 5000 + "?"), (4, 1, "assistant", "  \t\n"), (4, 1, "assistant", "  \t\n"),
        (5, 0, "", ""), (6, 3, "user", "q?"),
    ]
    # a long conversation whose blocks are many when BLOCK is small
    roles = ["user", "assistant", "assistant", "system", "user", "tool"]
    rows += [(7, t, roles[t % 6], f"line {t % 5}" + ("." if t % 3 else "")) for t in range(40)]
    return rows


@pytest.mark.parametrize("block", [4096, 3, 1])
def test_repair_odd_rows_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV + ", audit string, cost int")
    assert _repaired(conversations.repair(df)) == brute.repair(rows)


def test_repair_of_an_empty_table_and_of_dropped_rows(spark):
    assert conversations.repair(spark.createDataFrame([], CONV)).count() == 0
    # find a row the damage drops: its conversation still answers with zeros
    import zlib

    turn = next(t for t in range(100) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    out = conversations.repair(spark.createDataFrame([(9, turn, "user", "gone.")], CONV)).collect()
    assert [tuple(r) for r in out] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_url_rules_against_plain(spark):
    urls_ = [
        "http://www.Example.COM/en/x", "https://example.com/en/", "https://a.example.com/en/z?q#f", "http://x.net/es/1",
        "http://x.net/fr", "http://x.net/fr/", "ftp://host.com", "http://host.com/", None, "no scheme/com/", "http://NET/es/",
        "http://example.com:80/en/", "http://e.com?x=/en/", "a://b://c.com/", "http://", "http://u@www.example.com/en/",
    ]
    df = spark.createDataFrame([(i, u, "junk") for i, u in enumerate(urls_)] + [(99, "http://x.net/es/", "again")] * 2, "page_id long, url string, html string")
    labels = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, labels).collect()}
    for i, u in [*enumerate(urls_), (99, "http://x.net/es/")]:
        host, path, rule, verdict = brute.url_rule(u, urls.RULES)
        assert got[i] == (host, path, rule, verdict or "allow"), u
    assert urls.judge(df, labels).count() == len(urls_) + 2


def test_url_reputation_blocks_a_bad_host(spark):
    pages = [(i, f"http://bad{i % 2}.spam.org/p{i}") for i in range(40)] + [(100 + i, f"http://good.ok.org/p{i}") for i in range(40)]
    pages += [(200, "http://new.spam.org/x"), (201, "http://other.ok.org/y"), (202, None)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(5, None)], "page_id long, bad int")
    got = {r.page_id: r.verdict for r in urls.judge(df, labels).collect()}
    assert {got[i] for i in range(40)} == {"block"}
    assert {got[100 + i] for i in range(40)} == {"allow"}
    # an unlabelled host of a bad domain takes the domain's reputation
    assert got[200] == "block" and got[201] == "allow" and got[202] == "allow"


def test_url_and_search_queries_equal_their_sql(spark):
    con = connect(FOLDER)
    for name in ("op12_url_filter", "op13_lexical_search"):
        assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], con) == [], name


def test_search_odd_rows_against_sql(spark, tmp_path):
    docs = [(1, "Cat cat DOG"), (2, None), (3, ""), (4, "cat"), (4, "cat"), (5, "dog-dog 42 é中 x_y"), (6, "!!!"), (7, "bird " * 3000)]
    items = [(0, "cat dog"), (1, None), (2, "42 é中"), (3, "bird cat"), (4, "zzz")]
    d = spark.createDataFrame([(*r, "en", "s") for r in docs], "doc_id long, text string, lang string, source string")
    b = spark.createDataFrame(items, "item_id long, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    b.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = search.search(d, b)
    assert compare(got, search.search_sql(), connect(str(tmp_path))) == []
    ranks = {(r.item_id, r.rank) for r in got.collect()}
    assert (0, 1) in ranks and not any(i in (1, 4) for i, _ in ranks)


def test_search_of_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(0, "cat")], "item_id long, text string")
    assert search.search(d, b).count() == 0
    assert search.search(spark.createDataFrame([(1, "cat")], "doc_id long, text string"), b.limit(0)).count() == 0


def test_search_keeps_fifty_with_ties(spark):
    d = spark.createDataFrame([(i, "cat dog" if i % 2 else "cat") for i in range(120)], "doc_id long, text string")
    b = spark.createDataFrame([(0, "cat dog")], "item_id long, text string")
    got = [(r.rank, r.doc_id) for r in search.search(d, b).orderBy("rank").collect()]
    assert len(got) == 50 and [r for r, _ in got] == list(range(1, 51))
    assert [x for _, x in got] == sorted(x for x in range(120) if x % 2)[:50]
