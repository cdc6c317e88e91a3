"""Stored points and fitted models: upsert in place, model versions by alias."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from .common import stored


@dataclass(frozen=True)
class PointStore:
    """SNK10: a table of points ``path``, in ``buckets`` folders by a hash of
    the key. A batch that is sent rewrites the buckets it has points in and no
    other; a task writes a bucket."""

    spark: SparkSession
    path: str
    key: str = "point_id"
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int").alias("bucket")

    def _once(self, points: DataFrame) -> DataFrame:
        """One row a key: of points sent twice in one batch, the largest row."""
        rest = [c for c in points.columns if c != self.key]
        return points.groupBy(self.key).agg(F.max(F.struct(*rest)).alias("_r")).select(self.key, "_r.*")

    def _write(self, points: DataFrame) -> None:
        (points.select("*", self._bucket()).repartition(self.buckets, "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def recreate(self, points: DataFrame) -> None:
        """SNK10: replace everything that is stored."""
        rows = self._once(points).select("*", self._bucket()).repartition(self.buckets, "bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self.path)

    def upsert(self, points: DataFrame) -> int:
        """SNK10: add new points and replace those whose key is sent again; returns how
        many buckets were rewritten. The rewritten buckets are put together in
        the scratch folder first, so a failed job leaves the store as it was."""
        new = stored(self._once(points), "points-sent")
        hit = [r[0] for r in new.select(self._bucket()).distinct().collect()]  # at most one number a bucket
        if not hit:
            return 0
        merged = new
        if path_exists(self.spark, self.path):
            held = self.spark.read.parquet(self.path).filter(F.col("bucket").isin(hit)).drop("bucket")
            merged = stored(held.join(new.select(self.key), self.key, "left_anti").unionByName(new, allowMissingColumns=True), "points-merged")
        self._write(merged)
        return len(hit)


@dataclass(frozen=True)
class ModelStore:
    """ML13: fitted pipelines under ``root``, one folder per name and version,
    beside the tables of versions and aliases (:mod:`ragloom.operators.ml`)."""

    spark: SparkSession
    root: str

    def path(self, name: str, version: int) -> str:
        return f"{self.root.rstrip('/')}/{name}/version={version}"

    def save(self, name: str, version: int, model: PipelineModel) -> str:
        """ML13: store a fitted model; versions are never overwritten."""
        path = self.path(name, version)
        model.save(path)
        return path

    def load(self, aliases: DataFrame, name: str, alias: str) -> PipelineModel:
        """JON13: the model that the alias table ``(name, alias, version)`` points to."""
        row = aliases.filter((F.col("name") == name) & (F.col("alias") == alias)).select("version").first()
        if row is None:
            raise KeyError(f"{name} has no alias {alias}")
        return PipelineModel.load(self.path(name, row["version"]))


def score_by_alias(store: ModelStore, aliases: DataFrame, name: str, alias: str, df: DataFrame, positive: str = "approved", negative: str = "rejected") -> DataFrame:
    """ML11: batch scoring with the stored model of a name and alias."""
    from .ml import score

    return score(store.load(aliases, name, alias), df, positive, negative)
