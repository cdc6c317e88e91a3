"""Connected components of an edge table, by alternating stars.

Every round hangs each node's larger neighbours, then its smaller ones, under
the smallest node it can see; both halves are a grouped minimum and a join, so
a node with very many neighbours is pre-aggregated before the shuffle and its
join may be split. Rounds end when the edges no longer change; each round's
edges are a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another one;
    the component is its smallest node. Edges may point either way and repeat;
    loops and edges with a null end are ignored."""
    cur = stored(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                 .where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    seen = _state(cur)
    while True:
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("_m", "u").alias("_m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("_u"))
                 .select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct())
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("_m")).withColumnRenamed("u", "_u")
        hung = large.join(low, F.col("u") == F.col("_u")).where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
        cur = stored(hung.unionAll(low.select(F.col("_u").alias("u"), F.col("_m").alias("v"))).distinct(), "edges")
        now = _state(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
