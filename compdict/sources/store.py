"""A versioned store of component tables in key buckets, rewritten bucket by bucket.

Every table is kept in ``buckets`` buckets of its component key (``pmod(xxhash64(upper(key)),
buckets)``), so all rows of a component sit in one bucket of every table.  A *manifest* names,
for each version, table and bucket, the folder that holds that bucket's files.  A round:

1. the keys that change or go are put in their buckets (at most ``buckets`` numbers reach the
   driver);
2. for each table, only the touched buckets are read, their rows of those keys are left out,
   the new rows are added, and the result is written to a new folder, split by bucket;
3. the manifest of the next version takes the new folders for touched buckets and the old ones
   for all others, and is written in one step; a one-row append to ``versions`` then makes it
   current.

Readers take the last version in ``versions``, so a round that fails leaves the store as it was;
untouched buckets keep their files, so a round costs the size of what it touches.  Nothing is
listed but the folders of one write (at most ``buckets`` names).
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from compdict.checkpoints import cut

BUCKETS = 64
# keys of a round that are joined by broadcast; more go by a shuffle join
BROADCAST_KEYS = 1_000_000


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a component key; the key's case does not matter."""
    return F.pmod(F.xxhash64(F.upper(key)), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def current_version(spark: SparkSession, root: str) -> int:
    """Last complete version, 0 when there is none."""
    if not _exists(spark, f"{root}/versions"):
        return 0
    return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0] or 0


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``(table, bucket, path, key, layout)`` of a version (the last complete one by default)."""
    version = version or current_version(spark, root)
    return spark.read.parquet(f"{root}/manifests/version={version}")


def _written_buckets(spark: SparkSession, folder: str) -> dict[int, str]:
    """Bucket folders of one write: at most as many as there are buckets."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    out = {}
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("_bucket="):
            out[int(name.split("=", 1)[1])] = status.getPath().toString()
    return out


def _write(df: DataFrame, key: str, folder: str, buckets: int) -> None:
    df.withColumn("_bucket", bucket_of(F.col(key), buckets)).write.partitionBy("_bucket").parquet(folder)


def _commit(spark: SparkSession, root: str, version: int, rows: list[tuple]) -> int:
    spark.createDataFrame(rows, "table string, bucket int, path string, key string, layout string").coalesce(1).write.parquet(
        f"{root}/manifests/version={version}"
    )
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/versions")
    return version


def create(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, str]], buckets: int = BUCKETS) -> int:
    """Write the first version of ``{name: (rows, key column)}``; returns its number."""
    version = current_version(spark, root) + 1
    rows = []
    for name, (df, key) in tables.items():
        folder = f"{root}/data/{name}/{uuid.uuid4()}"
        _write(df, key, folder, buckets)
        layout = df.schema.json()
        rows += [(name, b, path, key, layout) for b, path in sorted(_written_buckets(spark, folder).items())]
        rows.append((name, -1, None, key, layout))  # the table's layout, also when it is empty
    return _commit(spark, root, version, rows)


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """All rows of one table in a version."""
    entries = manifest(spark, root, version).filter(F.col("table") == name).collect()
    layout = StructType.fromJson(json.loads(entries[0]["layout"]))
    paths = [e["path"] for e in entries if e["path"] is not None]
    if not paths:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(*paths)


def apply_round(
    spark: SparkSession, root: str, new: dict[str, DataFrame], drop: DataFrame, buckets: int = BUCKETS,
) -> tuple[int, list[int]]:
    """Replace the components of ``drop`` (column ``_key``) by the rows of ``new``; returns the
    new version and the buckets it rewrote.

    ``drop`` holds every key that changes or goes; a key with rows in ``new`` is replaced as
    well.  Tables absent from ``new`` only lose rows.
    """
    old = manifest(spark, root).collect()
    version = current_version(spark, root) + 1
    by_table: dict[str, list] = {}
    for e in old:
        by_table.setdefault(e["table"], []).append(e)
    # a component with new rows is replaced too, so its bucket is touched whatever ``drop`` says
    keys = [drop.select(F.upper("_key").alias("_key"))] + [
        df.select(F.upper(F.col(by_table[name][0]["key"])).alias("_key")) for name, df in new.items()
    ]
    # counted, put in buckets and joined with every table, so they are worked out once
    drop = cut(reduce(DataFrame.unionByName, keys).distinct())
    touched = sorted(r[0] for r in drop.select(bucket_of(F.col("_key"), buckets)).distinct().collect())
    if drop.count() <= BROADCAST_KEYS:
        drop = F.broadcast(drop)
    rows = []
    for name, entries in by_table.items():
        key, layout = entries[0]["key"], entries[0]["layout"]
        schema = StructType.fromJson(json.loads(layout))
        rows.append((name, -1, None, key, layout))
        kept = [(e["table"], e["bucket"], e["path"], key, layout) for e in entries if e["path"] is not None and e["bucket"] not in touched]
        rows += kept
        if not touched:
            continue
        paths = [e["path"] for e in entries if e["path"] is not None and e["bucket"] in touched]
        before = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        left = before.join(drop, F.upper(F.col(key)) == F.col("_key"), "left_anti")
        parts = [left] + ([new[name].select(*schema.names)] if name in new else [])
        folder = f"{root}/data/{name}/{uuid.uuid4()}"
        _write(reduce(DataFrame.unionByName, parts), key, folder, buckets)
        rows += [(name, b, path, key, layout) for b, path in sorted(_written_buckets(spark, folder).items())]
    return _commit(spark, root, version, rows), touched
