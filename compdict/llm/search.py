"""Ranked lexical search of many queries at once, with shared work between queries.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, with only A-Z
lower-cased.  Over the documents: ``N`` documents have a term, ``L`` terms in all; a document has
``n`` terms, a term is in ``df`` documents and ``tf`` times in one.  A term weighs
``w = floor(1000 ln((2N+2)/(2df+1)))`` (doubles); everything else is 64-bit integer arithmetic:
``m = 50 + (50 n N) div L`` and a document scores ``sum w * ((10^9 tf) div (1000 tf + 20 m))`` over
the query's distinct terms.

Many queries share terms.  The terms are grouped by the exact set of queries they occur in
(*shared term sets*: every set is the largest one that the same queries have in common), a
document's partial score is summed once per shared set, and each query adds the partial scores
of the sets it holds.  The sharing is a two-level DAG, term -> shared set -> query, so a term in a
thousand queries is scored against a document once, not a thousand times.  The top ``k`` of each
query come from a window with a rank limit, which Spark cuts within each task before the shuffle.
Work and the written rows grow with (documents x asked terms they hold); the scored pairs with
(queries x documents that share a term with them), which exact top-k ranking must see.

Odd rows: null texts have no terms (empty documents count neither in ``N`` nor ``L``); queries
without terms give no rows; repeated documents are ranked as separate rows (equal scores and
IDs); an empty table gives no rows; only the ID and text columns are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from compdict.checkpoints import cut, shared_folder
from compdict.llm.common import ascii_lower, once

# --- fixed values: what a term is, the contract's constants
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
SHARED_BROADCAST_ROWS = 2_000_000


def terms(text: Column) -> Column:
    """The terms of a text: it is split at runs of separators (the complement of ``TERM``);
    only a text that starts or ends with one gives an empty part, which is dropped."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def shared_sets(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(term, tid, set_id)`` and ``(set_id, query)`` from ``(query, term)`` rows.

    A set is all terms held by exactly the same queries; its ID is a hash of that query list.
    ``tid`` numbers the asked terms.
    """
    by_term = queries.distinct().groupBy("term").agg(F.array_sort(F.collect_list("query")).alias("queries"))
    by_term = cut(by_term.withColumn("set_id", F.xxhash64("queries")).withColumn("tid", F.monotonically_increasing_id()))
    members = by_term.select("set_id", "queries").distinct().select("set_id", F.explode("queries").alias("query"))
    return by_term.select("term", "tid", "set_id"), members


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast when the row count is at most ``rows``, else leave to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def _runs(df: DataFrame, terms: str) -> DataFrame:
    """Adds ``_runs``: the distinct terms of a row with their counts, from the sorted terms.

    Counted within the row, so no occurrence is shuffled.
    """
    df = once(df, "_s", F.array_sort(terms))
    n = F.size("_s")
    df = once(df, "_starts", F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))))
    count = F.size("_starts")
    runs = F.when(count > 0, F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.struct(
            F.get("_s", F.get("_starts", k)).alias("term"),
            (F.coalesce(F.get("_starts", k + 1), n) - F.get("_starts", k)).cast("bigint").alias("tf"),
        ),
    ))
    return df.withColumn("_runs", F.coalesce(runs, F.array().cast("array<struct<term:string,tf:bigint>>"))).drop("_s", "_starts")


def _stash(df: DataFrame) -> DataFrame:
    """Write the rows as parquet to the shared folder once and read them back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/search-{uuid.uuid4()}"
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: each query's ``k`` best documents with a score above 0.

    Ranks run from 1; equal scores go by ascending document ID.

    Plan: one pass over the texts gives, per document, one row of its term count and one row per
    asked term it holds with its count (counted within the row); those compact rows are written
    once.  ``N`` and ``L`` come from the count rows, ``df`` from an aggregation of the term rows
    combined before its shuffle; the term rows then go once by document to the tasks that sum
    the shared sets and the queries, and the rank limit cuts each query to ``k`` rows a task
    before the last shuffle.
    """
    asked = queries.select(F.col(query_id).alias("query"), F.explode(terms(F.col(query_text))).alias("term"))
    term_sets, members = shared_sets(asked)
    wanted = _small(term_sets.select("term", "tid"), SHARED_BROADCAST_ROWS)

    rows = _runs(
        docs.select(F.col(doc_id).alias("_doc"), terms(F.col(text)).alias("_t")).withColumn("_row", F.monotonically_increasing_id()),
        "_t",
    )
    count_row = F.struct(F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("tf"))
    posted = _stash(
        rows.select("_row", "_doc", F.size("_t").cast("bigint").alias("_n"), F.explode(F.concat(F.array(count_row), "_runs")).alias("_p"))
        .select("_row", "_doc", "_n", "_p.term", "_p.tf")
        .join(wanted, "term", "left")
        .filter(F.col("term").isNull() | F.col("tid").isNotNull())
        .select("_row", "_doc", "_n", "tid", "tf")
    )
    totals = posted.filter(F.col("tid").isNull()).agg(F.count(F.when(F.col("_n") > 0, 1)), F.sum("_n")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    if n_docs == 0:
        return queries.sparkSession.createDataFrame([], f"{query_id} {_kind(queries, query_id)}, rank int, {doc_id} {_kind(docs, doc_id)}, score bigint")

    held = posted.filter(F.col("tid").isNotNull())
    weights = held.groupBy("tid").agg(F.count(F.lit(1)).alias("df")).select(
        "tid",
        F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.col("df") * 2 + 1))).cast("bigint").alias("w"),
    ).join(term_sets.select("tid", "set_id"), "tid")
    m = F.expr(f"50 + (50 * _n * {n_docs}L) div {n_terms}L")
    part = F.col("w") * F.expr("(1000000000 * tf) div (1000 * tf + 20 * _m)")
    # one shuffle by document: both sums below are then within tasks
    partial = (
        held.repartition("_row").withColumn("_m", m).join(_small(weights, SHARED_BROADCAST_ROWS), "tid")
        .groupBy("set_id", "_row", "_doc").agg(F.sum(part).alias("part"))
    )
    scored = (
        partial.join(_small(members, SHARED_BROADCAST_ROWS), "set_id")
        .groupBy("query", "_row", "_doc").agg(F.sum("part").alias("score"))
        .filter(F.col("score") > 0)
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("_doc"), F.asc("_row"))
    return (
        scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select(F.col("query").alias(query_id), F.col("rank").cast("int"), F.col("_doc").alias(doc_id), F.col("score").cast("bigint"))
    )


def _kind(df: DataFrame, column: str) -> str:
    return dict(df.dtypes)[column]


def search_sql(k: int = K) -> str:
    """The same in DuckDB SQL over ``documents`` and ``benchmark``."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    pattern = TERM
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low}, '{pattern}') AS t FROM documents),
stats AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS nn, sum(len(t)) AS ll FROM d),
e AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({low}, '{pattern}')) AS term FROM benchmark),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (
  SELECT q.item_id, tf.r, tf.doc_id,
    sum(CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), stats GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, CAST(score AS BIGINT) AS score
FROM s WHERE score > 0 QUALIFY rank <= {k}
"""
