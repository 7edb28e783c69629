"""Written intermediate tables.

A staged table cuts lineage and gives every reader the same rows, also after an
executor is lost.  It lives in the folder that the session names, either in
``spark.checkpoint.dir`` or with ``SparkContext.setCheckpointDir``.  Without one,
staging fails: a folder of the driver's own disk would be out of the executors' reach.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{staging_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once from the executors and read it back.  ``codec`` is Parquet's, that of
    the session by default; zstd makes tables of texts a third smaller."""
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
