"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a new local folder, but on local masters only."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        base = sc.getCheckpointDir()
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/parlance/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """df from a table in the shared folder: it is computed once, and a lost executor loses nothing of it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
