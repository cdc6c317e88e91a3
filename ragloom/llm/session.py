"""Session helpers of the operators: code shipping and shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ragloom.session import ensure_checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the executors and make sure a checkpoint folder is
    set (``spark.checkpoint.dir``; a fresh one only where it is unset)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage: the files outlive any executor, and all consumers read
    the same rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
