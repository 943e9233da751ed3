"""Where jobs put files that several executors must see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, or else the session's checkpoint folder.

    Driver and executors must all reach it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return configured.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name not used before, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    For rows that are costly to make and read more than once. Unlike a cache it outlives a lost
    executor, and a join sees a plain scan, of which it may split a skewed partition.
    """
    folder = new_folder(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
