"""Tables kept between jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; one of our own only where that is unset and all run in this process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not path and held.isDefined():
        path = held.get()
    if not path and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
    if not path:
        path = f"file://{tempfile.mkdtemp(prefix='kinfold-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
