"""Where a plan is cut: the shared folder the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; below the warehouse where none is named.

    A folder on one machine's disk is refused where executors run on several.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
