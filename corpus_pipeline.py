"""Five stages from raw documents to encoded text; each works on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
``run`` writes each stage as Parquet below the shared folder of the session and reads it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from compdict.checkpoints import shared_folder
from compdict.llm import contamination, jaccard, lines, pieces, toxicity
from compdict.llm.common import table
from compdict.llm.queries import MODEL, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half stay."""
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, model, keep=docs.columns).filter("predicted = 0").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on five sources or more leave all texts; a text whose lines all leave goes, others stay.

    ``n_chars`` is set anew where a line left.
    """
    made = lines.remove_spread_lines(docs)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return made.filter("_n_removed = 0 OR trim(text) <> ''").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest ID stays.

    Rows that share the ID, repeated or not, become one: the one with the first text.
    A null ID stands alone.
    """
    found = jaccard.near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = docs.join(found, "doc_id", "left_semi")
    one = kept.groupBy("doc_id").agg(F.min(F.struct(F.col("text"), *others)).alias("_row"))
    return one.select("doc_id", "_row.*").select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]
# Toxicity, encoding and connected components are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
