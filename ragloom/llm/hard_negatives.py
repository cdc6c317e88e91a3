"""Hard-negative mining with exact whole-number scores.

Vectors become whole numbers. Blocks of anchors meet blocks of rows in tasks,
tile by tile; a tile's scores are the product of two int64 matrices by
Strassen's recursion (zero padding, seven products of half the size, whole-number
additions). Bounded heaps keep each anchor's positives, and then, for every
positive, the best rows of other labels inside its score window. Heaps of equal
anchors merge to the heap of all their rows, so blocks need no order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import stored

LEAF = 32  # matrices up to this side are multiplied directly
TILE = 512, 2048  # anchors and rows of a tile
BLOCK_BYTES = 16 << 20  # of int64 components of one side's block, at most on average
SMALL_BYTES = 1 << 20  # blocks get no smaller than this for the sake of more tasks
MAX_NORM = 1 << 31  # of a whole-number vector: products of two stay within 64 bits


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices. Sides are padded with zeros to a multiple
    of a power of two. Additions may wrap around on the way; the result is exact
    wherever it fits 64 bits."""
    m, k, n = a.shape[0], a.shape[1], b.shape[0]
    levels = max(0, int(np.ceil(np.log2(max(min(m, k, n), 1) / leaf))))
    step = 1 << levels

    def padded(x: np.ndarray) -> np.ndarray:
        return np.pad(x, [(0, -s % step) for s in x.shape])

    return _product(padded(a), padded(b), levels)[:m, :n]


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b.T
    m, n, k = a.shape[0] // 2, b.shape[0] // 2, a.shape[1] // 2
    top, low, first, last = np.s_[:m, :k], np.s_[m:, :k], np.s_[:m, k:], np.s_[m:, k:]
    p, q, r, s = a[top], a[first], a[low], a[last]
    # b holds the right factor's columns as rows
    t, u, v, w = b[:n, :k], b[n:, :k], b[:n, k:], b[n:, k:]
    both = _product(p + s, t + w, levels - 1)
    lower, right = _product(r + s, t, levels - 1), _product(p, u - w, levels - 1)
    left, upper = _product(s, v - t, levels - 1), _product(p + q, w, levels - 1)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = both + left - upper + _product(q - s, v + w, levels - 1)
    out[:m, n:] = right + upper
    out[m:, :n] = lower + left
    out[m:, n:] = both - lower + right + _product(r - p, t + u, levels - 1)
    return out


@dataclass
class Heaps:
    """The best ``size`` entries of every heap: larger scores first, ties by the
    smaller id; an entry that comes twice counts once."""

    size: int
    heap: np.ndarray
    score: np.ndarray
    row: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Heaps:
        return cls(size, *(np.zeros(0, dtype=np.int64) for _ in range(3)))

    def merge(self, heap: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(heap):
            return
        heap, score, row = (np.concatenate(x) for x in ((self.heap, heap), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, heap))
        heap, score, row = heap[order], score[order], row[order]
        new = np.ones(len(heap), dtype=bool)
        new[1:] = (heap[1:] != heap[:-1]) | (score[1:] != score[:-1]) | (row[1:] != row[:-1])
        heap, score, row = heap[new], score[new], row[new]
        place = np.arange(len(heap)) - np.searchsorted(heap, heap)
        best = place < self.size
        self.heap, self.score, self.row = heap[best], score[best], row[best]

    def floors(self, low: np.ndarray) -> np.ndarray:
        """The score that an entry must reach to matter, for each heap: that of
        the last entry of a full heap, else ``low``."""
        out = low.copy()
        last = np.searchsorted(self.heap, np.arange(len(low)), side="right") - 1
        full = np.bincount(self.heap, minlength=len(low)) >= self.size
        out[full] = np.maximum(out[full], self.score[last[full]])
        return out


def score_tiles(anchors: np.ndarray, rows: np.ndarray, tile: tuple[int, int] | None = None) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Scores of all anchors with all rows, tile by tile."""
    high, wide = tile or TILE
    for j in range(0, len(rows), wide):
        for i in range(0, len(anchors), high):
            yield slice(i, i + high), slice(j, j + wide), strassen(anchors[i:i + high], rows[j:j + wide])


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score with ``low * positive <= 100 * score <=
    high * positive`` (empty for negative ones, as then low * positive is more),
    without leaving 64 bits."""
    part, rest = positive // 100, positive % 100
    return low * part - (-low * rest) // 100, high * part + (high * rest) // 100


def _whole(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * 256).astype(np.int64).reshape(rows, len(flat) // max(rows, 1))


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _anchor(table: pa.Table, at: np.ndarray) -> dict[str, pa.ChunkedArray]:
    return {c: table.column(c).take(pa.array(at)) for c in ("id", "h")}


def positives_in(anchors: pa.Table, rows: pa.Table, size: int) -> pa.Table:
    """The best ``size`` rows with another id for each anchor of a block."""
    heaps, ids, own = Heaps.empty(size), _ints(rows, "id"), _ints(anchors, "id")
    floor = np.full(len(own), np.iinfo(np.int64).min)
    for i, j, score in score_tiles(_whole(anchors.column("v"), len(own)), _whole(rows.column("v"), len(ids))):
        at, col = np.nonzero((score >= floor[i, None]) & (ids[None, j] != own[i, None]))
        heaps.merge(at + i.start, score[at, col], ids[j][col])
        floor = heaps.floors(floor)
    return pa.table({**_anchor(anchors, heaps.heap), "positive": heaps.row, "score": heaps.score})


def negatives_in(anchors: pa.Table, rows: pa.Table, size: int, low: int, high: int) -> pa.Table:
    """The best ``size`` rows of other labels in each positive's window, for the
    anchors of a block. ``anchors`` has a list of positives and their scores."""
    heaps, ids, label = Heaps.empty(size), _ints(rows, "id"), _ints(rows, "label")
    own, offsets = _ints(anchors, "label"), np.append(0, np.cumsum(anchors.column("positives").combine_chunks().value_lengths().to_numpy()))
    flat = anchors.column("positives").combine_chunks().flatten()
    positive, against = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
    low_end, high_end = window(against, low, high)
    floor = low_end
    for i, j, score in score_tiles(_whole(anchors.column("v"), len(own)), _whole(rows.column("v"), len(ids))):
        other = own[i, None] != label[None, j]
        # one window of every anchor at a time
        first, stop = offsets[:-1][i], offsets[1:][i]
        for k in range(int((stop - first).max(initial=0))):
            has = np.flatnonzero(first + k < stop)
            heap = first[has] + k
            fits = (score[has] >= floor[heap, None]) & (score[has] <= high_end[heap, None]) & other[has]
            at, col = np.nonzero(fits)
            heaps.merge(heap[at], score[has[at], col], ids[j][col])
        floor = heaps.floors(low_end)
    owner = np.searchsorted(offsets, heaps.heap, side="right") - 1
    return pa.table({**_anchor(anchors, owner), "positive": positive[heaps.heap], "against": against[heaps.heap], "negative": heaps.row, "score": heaps.score})


def prepared(vectors: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """``id, label, v`` of the rows that take part, each once."""
    v = F.col("v")
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    length = F.aggregate(v, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * 256 + 1, 2))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vec_col).alias("v"))
            .where(good).where(length < float(MAX_NORM) ** 2).distinct().withColumn("d", F.size("v")))


def _cut(df: DataFrame, rows: int, width: int, name: str) -> tuple[DataFrame, int]:
    """Deal the rows into numbered blocks by a hash of the whole row; also the
    number of blocks for ``rows`` rows. Blocks hold about ``BLOCK_BYTES`` at
    most, and less where that gives more tasks than there are cores."""
    size = rows * max(width, 1) * 8
    blocks = max(1, -(-size // BLOCK_BYTES), min(df.sparkSession.sparkContext.defaultParallelism, size // SMALL_BYTES))
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(name), "id", "label", "v"), F.lit(blocks))), blocks


def _meet(anchors: DataFrame, blocks_a: int, rows: DataFrame, blocks_r: int, keys: list[str],
          fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Every block of anchors with every block of rows of equal ``keys``; what is
    found for an anchor comes together, each row once."""
    def copies(df: DataFrame, name: str, n: int) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))

    at = [*keys, "ablock", "rblock"]
    found = copies(anchors, "rblock", blocks_r).groupBy(*at).cogroup(copies(rows, "ablock", blocks_a).groupBy(*at)).applyInArrow(fn, schema)
    return found.repartition("id", "h").distinct()


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: str | Column = "label", anchor: Column | None = None,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of every anchor and positive.

    Components become ``floor(256 * x)``; the score of two rows is the inner
    product. ``anchor`` says which rows are anchors (default: ids divisible by
    50). Positives of an anchor are the first ``positives`` rows of its label
    with another id; for each, the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * score <= high * positive_score`` are returned
    (higher scores first, ties by smaller id) as ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector, or with a null or non-finite component,
    take no part, nor do rows whose whole-number vector has a length of about
    2^31 or more (their scores need not fit a long). Only vectors with equally
    many components are scored; empty vectors score 0 with each other. Rows that
    repeat id, label and vector count once, as do rows of one id with one score;
    an anchor's own id is never its positive. An empty table, or one without
    anchors, gives an empty one. Other columns are not read. ``low`` and ``high``
    are at most 100.

    Both sides are dealt into blocks of bounded bytes by a hash of the row, so a
    hot label is many blocks; a block pair is one task's work, and at most
    ``positives * negatives`` rows an anchor leave it.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = stored(prepared(vectors, id_col, vec_col, label), "mining-rows")
    anchor = F.col("id") % 50 == 0 if anchor is None else anchor
    asks = stored(rows.where(anchor).withColumn("h", F.xxhash64("label", "v")), "mining-anchors")
    size = rows.agg(F.count(F.lit(1)), F.max("d"), F.count(F.when(anchor, 1))).first()
    n, width, n_asks = size[0], size[1] or 0, size[2]
    label_n = rows.groupBy("label", "d").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(anchor, 1)).alias("a"))
    most = label_n.agg(F.max("n"), F.max("a")).first()

    cut_asks, blocks_a = _cut(asks, most[1] or 0, width, "ablock")
    cut_rows, blocks_r = _cut(rows, most[0] or 0, width, "rblock")

    def nearest(a: pa.Table, r: pa.Table) -> pa.Table:
        return positives_in(a, r, positives)

    best = Window.partitionBy("id", "h").orderBy(F.col("score").desc(), "positive")
    held = _meet(cut_asks, blocks_a, cut_rows, blocks_r, ["label", "d"], nearest, "id bigint, h bigint, positive bigint, score bigint")
    held = held.withColumn("k", F.row_number().over(best)).where(F.col("k") <= positives)
    lists = stored(held.groupBy("id", "h").agg(F.collect_list(F.struct("positive", "score")).alias("positives")), "mining-positives")

    cut_asks, blocks_a = _cut(asks.join(lists, ["id", "h"]), n_asks, width, "ablock")
    cut_rows, blocks_r = _cut(rows, n, width, "rblock")

    def windows(a: pa.Table, r: pa.Table) -> pa.Table:
        return negatives_in(a, r, negatives, low, high)

    near = _meet(cut_asks, blocks_a, cut_rows, blocks_r, ["d"], windows,
                 "id bigint, h bigint, positive bigint, against bigint, negative bigint, score bigint")
    first = Window.partitionBy("id", "h", "positive", "against").orderBy(F.col("score").desc(), "negative")
    return (near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
                    F.col("against").alias("positive_score"), F.col("score").alias("negative_score")))
