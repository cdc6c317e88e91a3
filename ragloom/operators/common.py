"""Small building blocks shared by several jobs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_no",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order, computed without a one-task window.

    The frame is range-partitioned, sorted within partitions and written once
    to the shared scratch folder with each row's partition and place in it;
    counts and rows both come from that table, so they belong to one layout. A
    row's number is its partition's offset (a prefix sum over one count per
    partition) plus its place. End the order with a unique key if the numbers
    are to be the same in every run.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    laid = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))
    laid = stored(laid.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)).drop("_mid"), "row-number")
    counts = laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    out = laid.join(F.broadcast(offsets), "_pid")  # one row per partition
    return out.withColumn(name, (F.col("_off") + F.col("_local") + 1).cast("bigint")).drop("_pid", "_local", "_off")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared scratch space and read
    it back: all consumers see the same rows, and the lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_value_by(order: Column | str, value: Column | str) -> Column:
    """Value of the row with the smallest ``order`` (``min_by``)."""
    return F.min_by(value if isinstance(value, Column) else F.col(value), order if isinstance(order, Column) else F.col(order))


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(default))


def ensure_parallel(df: DataFrame) -> DataFrame:
    """Spread an input over the cluster before a Python-side scan when its scan
    would give fewer splits than the default parallelism (e.g. one small
    file). Decided from the plan's size estimate, so nothing runs here; what is
    moved is at most one split's size per core."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    split = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(target) if size < target * split else df
