from pyspark.sql import functions as F

from ragloom.operators import evals as E
from ragloom.operators.common import global_row_number


def _rows(spark, path, n=400_000):
    """Many rows in a few files, so that range bounds are sampled."""
    df = spark.range(n).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("key"), F.repeat(F.lit("x"), 50).alias("payload"),
                               (F.col("id") % 7 == 0).cast("int").alias("label"))
    df.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_row_numbers_are_the_ranks_on_many_rows(spark, tmp_path):
    df = _rows(spark, str(tmp_path / "rows"))
    got = global_row_number(df, ["key", "id"], "rn", partitions=8)
    from pyspark.sql import Window

    want = df.select("id", F.row_number().over(Window.orderBy("key", "id")).alias("w"))
    bad = got.join(want, "id").filter(F.col("rn") != F.col("w")).count()
    stats = got.agg(F.count_distinct("rn").alias("d"), F.max("rn").alias("m"), F.count_distinct("payload").alias("p")).first()
    assert bad == 0 and stats["d"] == stats["m"] == 400_000 and stats["p"] == 1


def test_split_follows_the_class_ranks_on_many_rows(spark, tmp_path):
    from pyspark.sql import Window

    df = _rows(spark, str(tmp_path / "rows"))
    got = E.stratified_split(df, "label", "id", seed=1).select("id", "split")
    w = Window.partitionBy("label").orderBy(E.seeded_order("id", 1), "id")
    ref = df.select("id", F.row_number().over(w).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("label")).alias("n"))
    ref = ref.select("id", F.when(F.col("r") <= F.round(F.col("n") * 0.7), "train").when(F.col("r") <= F.round(F.col("n") * 0.85), "val")
                     .otherwise("test").alias("want"))
    assert got.join(ref, "id").filter(F.col("split") != F.col("want")).count() == 0
