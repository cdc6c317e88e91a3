"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample (principal axes, then alternating
between the nearest binary code and the best rotation onto it) turns vectors
into balanced binary codes. The codes are cut into substrings of about
log2(rows) bits; each substring is the key of a table, and vectors that agree in
a substring are candidates. As keys get longer with the number of rows, buckets
keep their size, and more substrings (of random rotations of the same axes once
the learned code is used up) keep the share of pairs found. How many are needed
depends on how the data lie around their mean, so it is counted on planted pairs
at the threshold that go through the same keys. Candidates are ranked by the
cosine of the original vectors in double precision.

Links are counted where they are found and never listed as pairs: each task
returns, per vector, its number of new links and the smallest vector that they
connect it with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .session import stored


@dataclass(frozen=True)
class Index:
    """``least``: cosine of a link; ``miss``: share of planted pairs at
    ``least`` that no table may find; ``bucket``: rows per bucket that key
    lengths aim at; ``block``: rows of a bucket that are compared at a time;
    ``sample``: vectors the rotations are learned on and pairs are planted at;
    ``rounds``: of learning; ``pairs``: planted of each kind."""

    least: float = 0.9
    miss: float = 0.02
    bucket: int = 256
    block: int = 1024
    sample: int = 10_000
    rounds: int = 30
    pairs: int = 4_000

    def bits(self, rows: int) -> int:
        """Bits of a key for so many rows."""
        return max(6, math.ceil(math.log2(max(rows, 1) / self.bucket + 1)))


def learn_rotation(sample: np.ndarray, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and matrix (dimensions x bits) of iterative quantisation: at most 64
    principal axes, rotated so that signs lose as little as possible."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) else np.zeros(d)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(d))
    axes = axes[:, ::-1][:, :64]
    r, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
    flat = centred @ axes
    for _ in range(rounds if len(sample) else 0):
        u, _, vt = np.linalg.svd(np.where(flat @ r >= 0, 1.0, -1.0).T @ flat)
        r = (u @ vt).T
    return mean, axes @ r


def _signs(unit: np.ndarray, models: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.concatenate([(unit - mean) @ matrix >= 0 for mean, matrix in models], axis=1)


def _keys(unit: np.ndarray, models: list[tuple[np.ndarray, np.ndarray]], bits: int, tables: int) -> np.ndarray:
    """Keys of each vector in each table (vectors x tables)."""
    signs = _signs(unit, models)
    out = np.zeros((len(unit), tables), dtype=np.int64)
    for t in range(tables):
        for b in range(t * bits, (t + 1) * bits):
            out[:, t] = out[:, t] << 1 | signs[:, b]
    return out


def planted_pairs(unit: np.ndarray, least: float, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample and partners at cosine ``least``: ``n`` that differ
    in any direction, then ``n`` that differ as the vectors of the sample do
    (all of it on the principal axes)."""
    left = unit[rng.integers(0, len(unit), 2 * n)]
    free = rng.standard_normal(left.shape)
    off = free.copy()
    off[n:] = unit[rng.integers(0, len(unit), n)] - unit[rng.integers(0, len(unit), n)]
    across = lambda x: x - (x * left).sum(axis=1, keepdims=True) * left
    length = lambda x: np.sqrt((x * x).sum(axis=1, keepdims=True))
    off = across(off)
    off = np.where(length(off) > 1e-6, off, across(free))
    right = least * left + math.sqrt(1 - least * least) * off / np.maximum(length(off), 1e-12)
    return left, right / length(right)


def _needed(agree: np.ndarray, bits: int, miss: float) -> float:
    """Independent tables until pairs of these sign agreements are missed with
    ``miss`` on average."""
    lost = 1 - agree ** bits
    low, high = 0, 1
    while (lost ** high).mean() > miss:
        low, high = high, high * 2
        if high > 1 << 20:
            return math.inf
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if (lost ** mid).mean() > miss else (low, mid)
    return high


def plan_tables(unit: np.ndarray, rows: int, index: Index) -> tuple[list[tuple[np.ndarray, np.ndarray]], int, int]:
    """Rotations, bits of a key and number of tables for ``rows`` vectors like
    those of the sample.

    Tables are added until no more than ``index.miss`` of the planted pairs of
    either kind (two standard deviations included) share no key. Where the
    vectors lie so close together that shorter keys (down to none: all pairs
    are compared) take less than a quarter of the work, keys are shorter."""
    rng = np.random.default_rng(0)
    models = [learn_rotation(unit, index.rounds, 0)]
    width = models[0][1].shape[1]

    def further() -> None:
        r, _ = np.linalg.qr(rng.standard_normal((width, width)))
        models.append((models[0][0], models[0][1] @ r))

    while len(models) * width < 256:
        further()
    n = index.pairs
    left, right = planted_pairs(unit, index.least, n, rng)
    same = (_signs(left, models) == _signs(right, models)).mean(axis=1)
    chance = (_signs(left[:n], models) == _signs(unit[rng.integers(0, len(unit), n)], models)).mean(axis=1)

    def work(bits: int) -> float:  # carrying a vector counts as comparing it with a bucket
        return max(_needed(same[:n], bits, index.miss), _needed(same[n:], bits, index.miss)) * (index.bucket + rows * (chance ** bits).mean())

    bits = index.bits(rows)
    best = min(range(bits + 1), key=work)
    bits = best if work(best) < work(bits) / 4 else bits
    lost, tables, at, codes = np.ones(2 * n, dtype=bool), 0, 0, np.zeros((2 * n, 0), dtype=bool)
    while True:
        while codes.shape[1] < bits:
            if at == len(models):
                further()
            codes = np.concatenate([codes, _signs(left, models[at:at + 1]) == _signs(right, models[at:at + 1])], axis=1)
            at += 1
        lost &= ~codes[:, :bits].all(axis=1)
        codes, tables = codes[:, bits:], tables + 1
        most = max(lost[:n].sum(), lost[n:].sum())
        if most + 2 * math.sqrt(most) <= index.miss * n:
            return models[:max(at, 1)], bits, tables


def _unit(column: pa.Array, size: int) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow, no underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def count_links(ids: np.ndarray, unit: np.ndarray, weights: np.ndarray, keys: np.ndarray, table: int, left: np.ndarray,
                right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the rows ``left`` and ``right`` of a bucket of ``table``
    that no earlier table has: ids with new links, how many (weighted), and the
    smallest id they are connected with."""
    link = unit[left] @ unit[right].T >= least
    link &= ids[left][:, None] != ids[right][None, :]
    i, j = np.nonzero(link)
    for t in range(table):
        fresh = keys[left[i], t] != keys[right[j], t]
        i, j = i[fresh], j[fresh]
    a, b = left[i], right[j]
    links = np.bincount(a, weights[b], minlength=len(ids))
    if left is not right:
        links += np.bincount(b, weights[a], minlength=len(ids))
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    some = np.flatnonzero(links > 0)
    return ids[some], links[some].astype(np.int64), root[some]


def _valid(vector: str) -> F.Column:
    v = F.col(vector)
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & whole & F.exists(v, lambda x: x != 0)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", index: Index = Index()) -> DataFrame:
    """Links of cosine ``index.least`` or more between all vectors.

    Returns one row per distinct id: the id column, ``n_links`` (other ids
    linked directly), ``component_id`` (smallest id reachable by links, itself
    included) and ``kept`` (it is that id). Equal vectors are compared once and
    count as often as they occur. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing, nor do vectors of
    different lengths with each other. Of several vectors under one id one
    counts (the smallest by hash); repeated rows count once. Rows with a null
    id come back one by one, linked with nothing, without a component, kept.
    Other columns are not read; an empty table gives an empty one.

    The rotations are fitted to at most ``index.sample`` vectors; all rows are
    indexed. Of links just at the threshold a share of ``1 - index.miss`` or more
    is found, as counted on pairs planted at those vectors; none below the
    threshold is returned.
    """
    src = rows.select(rows[id_col].alias("_id"), rows[vector_col].cast("array<double>").alias("_v"))
    named = src.where(F.col("_id").isNotNull())
    good = named.where(_valid("_v")).withColumn("_key", F.struct(F.size("_v").alias("n"), F.xxhash64(F.lit(1), "_v").alias("a"), F.xxhash64(F.lit(2), "_v").alias("b")))
    member = stored(good.groupBy("_id").agg(F.min("_key").alias("_key")), "vector-keys")
    classes = member.groupBy("_key").agg(F.min("_id").alias("_node"), F.count(F.lit(1)).alias("_weight"))
    classes = stored(classes, "vector-classes")
    nodes = stored(good.join(classes, (F.col("_id") == F.col("_node")) & (good["_key"] == classes["_key"]))
                   .select("_node", "_weight", "_v", F.col("_id")).dropDuplicates(["_node"]).drop("_id"), "vectors")
    found = []
    for r in nodes.groupBy(F.size("_v").alias("n")).count().collect():  # one index per vector length
        found.append(_links(nodes.where(F.size("_v") == r["n"]), r["n"], r["count"], index))
    out = member.join(classes, "_key").select(F.col("_id").alias("_mid"), "_node", "_weight")
    if found:
        links = found[0]
        for f in found[1:]:
            links = links.unionAll(f)
        links = stored(links, "vector-links")
        comps = components(links, "_node", "root")
        total = links.groupBy("_node").agg(F.sum("links").alias("links")).withColumnRenamed("_node", "_n")
        out = (out.join(total, F.col("_node") == F.col("_n"), "left").join(comps, F.col("_node") == F.col("node"), "left")
               .select("_mid", (F.coalesce("links", F.lit(0)) + F.col("_weight") - 1).alias("n_links"), F.coalesce("component", "_node").alias("component_id")))
    else:
        out = out.select("_mid", (F.col("_weight") - 1).alias("n_links"), F.col("_node").alias("component_id"))
    alone = F.col("component_id").isNull()
    whole = (named.select("_id").distinct().join(out, F.col("_id") == F.col("_mid"), "left")
             .select(F.col("_id"), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
                     F.coalesce("component_id", "_id").alias("component_id")))
    nulls = src.where(F.col("_id").isNull()).select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"))
    return whole.unionAll(nulls).select(F.col("_id").alias(id_col), "n_links", "component_id",
                                        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links(nodes: DataFrame, size: int, rows: int, index: Index) -> DataFrame:
    """(_node, links, root) rows of all tables, for vectors of one length."""
    sample = nodes.select("_node", "_v").orderBy(F.xxhash64("_node"), "_node").limit(index.sample).toArrow()
    models, bits, tables = plan_tables(_unit(sample.column("_v"), size), rows, index)
    kind = nodes.schema["_node"].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(_unit(batch.column(2), size), models, bits, tables)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))], ["_node", "_weight", "_v", "_keys"])

    coded = stored(nodes.select("_node", "_weight", "_v").mapInArrow(keyed, f"_node {kind}, _weight bigint, _v array<double>, _keys array<bigint>"), "vector-codes")
    cells = coded.select("_node", F.posexplode("_keys").alias("_t", "_k"))
    crowd = cells.groupBy("_t", "_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # blocks of a bucket: a row goes to every pair of blocks that its own is in
    blocks = F.ceil(F.col("_n") / index.block).cast("int")
    own = F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int")
    spread = (cells.join(crowd, ["_t", "_k"]).withColumn("_blocks", blocks).withColumn("_own", own)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .select("_node", "_t", "_k", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")))
    least = index.least

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        table, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        ids, own = group.column("_node").to_numpy(), group.column("_own").to_numpy()
        keys = group.column("_keys").combine_chunks().flatten().to_numpy().reshape(len(ids), tables)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        got = count_links(ids, _unit(group.column("_v"), size), group.column("_weight").to_numpy(), keys, table, left, left if i == j else right, least)
        return pa.table({"_node": got[0], "links": got[1], "root": got[2]})

    full = spread.join(coded, "_node")
    return full.groupBy("_t", "_k", "_i", "_j").applyInArrow(compare, f"_node {kind}, links bigint, root {kind}")
