"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

A token gives two units, its lower-cased letters and its shape (runs of capital
letters, other letters, digits, and every other character as itself). Each unit
has a random index vector (sparse, of -1 and 1) and a unit's vector is the sum
of the index vectors of the tokens next to it, over all its places in all
documents (whole numbers, summed in tasks). A document is the mean and the spread
of its units' vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import sigmoid
from .shingles import column_blocks, mix, text_blocks, word_hashes

UNIT_BITS = 14
CHUNK = 1 << 4  # units whose sums travel in one row
_U = np.uint64

_TOKEN = np.array([b > 32 for b in range(256)])
_CLASS = np.array([88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class QualitySettings:
    """``rows``: at most so many labelled rows are used; ``size``: of the
    vectors; ``hidden``: units of the first layer; ``steps``: of training;
    ``seed``: of the index vectors and first weights."""

    rows: int = 6_000
    size: int = 32
    hidden: int = 32
    steps: int = 600
    seed: int = 7


def _shapes(texts: Sequence[str | None]) -> list[str]:
    """Texts in which every token is its shape."""
    out = []
    for t in texts:
        raw = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kind = _CLASS[raw]
        keep = np.ones(len(kind), dtype=bool)
        keep[1:] = (kind[1:] != kind[:-1]) | (raw[1:] <= 32)
        out.append(kind[keep].tobytes().decode("ascii"))
    return out


def units(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and shape unit of every token, and the offsets of each text's
    tokens (runs of bytes above 32)."""
    words, offsets = word_hashes(texts, inside=_TOKEN)
    shapes, _ = word_hashes(_shapes(texts), lower=False, inside=_TOKEN)
    shift = _U(64 - UNIT_BITS)
    return (words >> shift).astype(np.int64), (mix(shapes) >> shift).astype(np.int64), offsets


def index_vectors(settings: QualitySettings) -> np.ndarray:
    """Random index vectors of all units: a tenth of the places 1, a tenth -1."""
    rng = np.random.default_rng(settings.seed)
    return rng.choice(np.array([-1.0, 0, 0, 0, 0, 0, 0, 0, 0, 1.0], dtype=np.float32), size=(2 << UNIT_BITS, settings.size))


def add_neighbours(total: np.ndarray, texts: Sequence[str | None], index: np.ndarray) -> None:
    """Add to ``total`` (units x size, whole numbers), for every token, the index
    vectors of the tokens before and after it in its text."""
    for i, j in text_blocks(texts):
        w, s, offsets = units(texts[i:j])
        own = index[w] + index[(1 << UNIT_BITS) + s]
        near = np.zeros_like(own)
        doc = np.repeat(np.arange(j - i), np.diff(offsets))
        same = (doc[1:] == doc[:-1])[:, None]
        near[1:] += own[:-1] * same
        near[:-1] += own[1:] * same
        for ids in (w, s + (1 << UNIT_BITS)):
            order = np.argsort(ids.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.diff(ids[order], prepend=-1))
            if len(first):
                total[ids[order][first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.float64).astype(np.int64)


def _directions(total: np.ndarray) -> np.ndarray:
    length = np.sqrt((total.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return (total / np.maximum(length, 1e-6)).astype(np.float32)


def unit_vectors(texts: Sequence[str | None], settings: QualitySettings) -> np.ndarray:
    """Vectors of all units (words, then shapes): index vectors of the tokens
    before and after, summed over the texts and brought to length one."""
    index = index_vectors(settings)
    total = np.zeros(index.shape, dtype=np.int64)
    add_neighbours(total, texts, index)
    return _directions(total)


def corpus_vectors(docs: DataFrame, text_col: str, settings: QualitySettings) -> np.ndarray:
    """:func:`unit_vectors` of all rows of ``docs``. Each task sums its texts and
    gives the sums of ``CHUNK`` units a row; only the matrix, whose size is
    fixed, reaches the driver. Sums are whole numbers, so their order is free."""
    size = settings.size
    kind = "chunk int, sums array<bigint>"

    def rows(chunks: list[int], sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if chunks:
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * CHUNK * size, pa.int32()), pa.array(np.concatenate(sums), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), lists], ["chunk", "sums"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors(settings)
        total = np.zeros(index.shape, dtype=np.int64)
        for batch in batches:
            for _, _, texts in column_blocks(batch.column(0)):
                add_neighbours(total, texts, index)
        chunks = total.reshape(-1, CHUNK * size)
        some = np.flatnonzero(chunks.any(axis=1))
        yield from rows(some.tolist(), list(chunks[some]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(1).flatten().to_numpy().reshape(-1, CHUNK * size)
            for c, sums in zip(batch.column(0).to_pylist(), parts, strict=True):
                total[c] = total[c] + sums if c in total else sums.copy()
        yield from rows(list(total), list(total.values()))

    got = docs.select(text_col).mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind).toArrow()
    total = np.zeros(((2 << UNIT_BITS) // CHUNK, CHUNK * size), dtype=np.int64)
    for c, sums in zip(got.column("chunk").to_pylist(), got.column("sums"), strict=True):
        total[c] = sums.values.to_numpy()
    return _directions(total.reshape(-1, size))


def pooled(texts: Sequence[str | None], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word and the shape vectors of each text, and the
    logarithm of its number of tokens; zeros for texts without tokens."""
    size = vectors.shape[1]
    out = np.zeros((len(texts), 4 * size + 1))
    for i, j in text_blocks(texts):
        w, s, offsets = units(texts[i:j])
        n = np.diff(offsets)
        some = np.flatnonzero(n > 0)
        if not len(some):
            continue
        for k, ids in enumerate((w, s + (1 << UNIT_BITS))):
            v = vectors[ids]
            mean = np.add.reduceat(v, offsets[some], axis=0, dtype=np.float64) / n[some, None]
            square = np.add.reduceat(v * v, offsets[some], axis=0, dtype=np.float64) / n[some, None]
            out[i + some, 2 * k * size:(2 * k + 1) * size] = mean
            out[i + some, (2 * k + 1) * size:(2 * k + 2) * size] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[i + some, -1] = np.log1p(n[some])
    return out


@dataclass(frozen=True)
class Network:
    """Unit vectors, scaling of the pooled features, two layers, temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def predict(self, texts: Sequence[str | None]) -> np.ndarray:
        return sigmoid(self.logits(pooled(texts, self.vectors)) / self.temperature)


def _train(x: np.ndarray, y: np.ndarray, settings: QualitySettings) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    rng = np.random.default_rng(settings.seed + 1)
    h = settings.hidden
    p = [rng.standard_normal((x.shape[1], h)) / np.sqrt(x.shape[1]), np.zeros(h), rng.standard_normal(h) / np.sqrt(h), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    pos = max(y.sum(), 1)
    cost = np.where(y > 0, len(y) / (2 * pos), len(y) / (2 * max(len(y) - y.sum(), 1)))
    for step in range(1, settings.steps + 1):
        rows = rng.integers(0, len(y), 256)
        a = np.tanh(x[rows] @ p[0] + p[1])
        r = cost[rows] * (sigmoid(a @ p[2] + p[3][0]) - y[rows]) / len(rows)
        back = np.outer(r, p[2]) * (1 - a * a)
        grads = [x[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), a.T @ r + 1e-4 * p[2], np.array([r.sum()])]
        for k, g in enumerate(grads):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] -= 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return p[0], p[1], p[2], float(p[3][0])


def fit_network(x: np.ndarray, labels: np.ndarray, vectors: np.ndarray, settings: QualitySettings = QualitySettings()) -> Network:
    """Network and temperature from a bounded list of pooled features of labelled
    texts. A fifth of the rows is kept from training to find the temperature (the
    one of least log loss there). With one class only, or no rows, the network
    gives that class's rate, or one half."""
    y = np.asarray(labels, dtype=float)
    centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(x.shape[1])
    kept = np.arange(len(y)) % 5 == 0
    if len(y) < 10 or len(set(y[~kept])) < 2:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        zero = np.zeros((x.shape[1], 1))
        return Network(vectors, centre, scale, (zero, np.zeros(1), np.zeros(1), float(np.log(rate / (1 - rate)))), 1.0)
    layers = _train((x[~kept] - centre) / scale, y[~kept], settings)
    raw = Network(vectors, centre, scale, layers, 1.0)
    z = raw.logits(x[kept])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, np.where(y[kept] > 0, -z, z) / t)) for t in grid]
    return Network(vectors, centre, scale, layers, float(grid[int(np.argmin(loss))]))


def fit(labelled: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", settings: QualitySettings = QualitySettings(),
        docs: DataFrame | None = None) -> Network:
    """Word vectors from all rows of ``docs`` (of ``labelled`` where it is None),
    and a network fitted to at most ``settings.rows`` labelled rows (those with
    the smallest hashes of their ids), of which only the pooled features reach
    the driver; rows with a null label are left out."""
    vectors = corpus_vectors(labelled if docs is None else docs, text_col, settings)
    rows = labelled.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), F.col(text_col).alias("_text"))
    width = 4 * settings.size + 1

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in column_blocks(batch.column(2)):
                x = pa.array(list(pooled(texts, vectors)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns[:2], x], ["_id", "_y", "_x"])

    kind = rows.schema["_id"].dataType.simpleString()
    got = (rows.mapInArrow(pool, f"_id {kind}, _y int, _x array<double>").orderBy(F.xxhash64("_id"), "_id").limit(settings.rows).toArrow())
    x = got.column("_x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return fit_network(x, got.column("_y").to_numpy(), vectors, settings)


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Calibrated probability of label 1 for every whole text.

    Returns one row per input row: the id column and ``score``. Only the text
    enters the score. Null and empty texts are documents without tokens.
    Repeated rows and null ids stay; other columns are not read; an empty table
    gives an empty one. Nothing is shuffled.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *(network.predict(texts) for _, _, texts in column_blocks(batch.column(1)))]))], [id_col, "score"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema['_id'].dataType.simpleString()}, score double")
