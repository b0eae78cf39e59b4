"""The operators as queries over the driver tables, with SQL where SQL can say the same."""

from __future__ import annotations

import importlib.util

from pyspark.sql import functions as F

from compdict.llm import (
    contamination, conversations, counts, jaccard, language, licenses, lines, neighbours, pieces, search, shards, toxicity, urls,
)
from compdict.llm.common import id_remainder, table

if importlib.util.find_spec("public_tokenizers"):
    import public_tokenizers

    MODEL = public_tokenizers.path("piece_bpe_32k.model")
else:
    MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark, d):
    return pieces.encode(table(spark, d, "documents"), MODEL, full=False)


def toxicity_model(spark, docs, d):
    """Learned from labels whose document is not held out."""
    labels = table(spark, d, "labels").filter(id_remainder("doc_id", 5) != 0)
    return toxicity.fit(docs, labels)


def op2_toxicity(spark, d):
    docs = table(spark, d, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, d))
    held = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_token_counts(spark, d):
    return counts.count_tokens(table(spark, d, "documents"), MODEL)


def op4_language(spark, d):
    docs = table(spark, d, "documents")
    model = language.fit(docs.filter(id_remainder("doc_id", 4) != 2))
    held = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(True))
    return language.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_licenses(spark, d):
    return licenses.scan(table(spark, d, "documents"))


def op6_shards(spark, d):
    return shards.shard(table(spark, d, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_line_dedup(spark, d):
    cleaned = lines.remove_spread_lines(table(spark, d, "documents"))
    return cleaned.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source, string_split(text, chr(10)) AS l FROM documents),
e AS (SELECT r, source, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM d),
spread AS (SELECT line FROM e WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= 5),
g AS (SELECT r, count(*) FILTER (WHERE line NOT IN (SELECT line FROM spread)) AS kept,
  coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE line NOT IN (SELECT line FROM spread)), '') AS text FROM e GROUP BY r)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(l) - kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(g.text, '')) AS text_sha256
FROM d LEFT JOIN g USING (r)
"""


def op8_decontamination(spark, d):
    return contamination.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op9_jaccard(spark, d):
    return jaccard.near_duplicates(table(spark, d, "documents"))


def op10_neighbours(spark, d):
    rows = table(spark, d, "embeddings")
    return neighbours.search(rows, rows.filter("vec_id % 20 = 0"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_toxicity, op3_token_counts, op4_language, op5_licenses, op6_shards,
        op7_line_dedup, op8_decontamination, op9_jaccard, op10_neighbours,
    )
}
ORACLES = {"op5_licenses": licenses.scan_sql(), "op7_line_dedup": OP7_SQL}


def op11_conversation_repair(spark, d):
    return conversations.repair(table(spark, d, "conversations"))


def op12_url_filter(spark, d):
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return urls.judge(table(spark, d, "pages"), labels)


def op13_lexical_search(spark, d):
    return search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES.update({f.__name__: f for f in (op11_conversation_repair, op12_url_filter, op13_lexical_search)})
ORACLES["op12_url_filter"] = urls.judge_sql()
ORACLES["op13_lexical_search"] = search.search_sql()
