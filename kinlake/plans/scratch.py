"""Tables between the steps of an iteration."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder of spark.checkpoint.dir; one of our own only where that is unset and the master is local (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spark-kinlake-')}"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
