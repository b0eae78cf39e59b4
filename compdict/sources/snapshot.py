"""Tables of one run kept together: a new version is seen only once all of it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def current_version(spark: SparkSession, root: str) -> int:
    """Last complete version, 0 when there is none."""
    if not _exists(spark, f"{root}/versions"):
        return 0
    return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0] or 0


def write_snapshot(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> int:
    """Write all tables as the next version, then announce it with one appended row."""
    version = current_version(spark, root) + 1
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/data/{version}/{name}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/versions")
    return version


def read_snapshot(spark: SparkSession, root: str, names, version: int | None = None) -> dict[str, DataFrame]:
    """Tables of the last complete version, or of a given one."""
    version = version or current_version(spark, root)
    return {name: spark.read.parquet(f"{root}/data/{version}/{name}") for name in names}


def read_table(spark: SparkSession, source: str, name: str, **jdbc: str) -> DataFrame:
    """One stored table: a parquet folder, or a database table when ``source`` is a JDBC URL."""
    if source.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=source, dbtable=name, **jdbc).load()
    return spark.read.parquet(f"{source}/{name}")
