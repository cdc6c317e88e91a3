"""Toxicity categories by a classifier chain.

Categories are predicted one after the other; each linear model sees the hashed
words and word beginnings of a text and the probabilities of all categories
before it. While training, those probabilities come from models that have not
seen the row (out-of-fold predictions), so that a later model learns to trust
them as far as they hold on new texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import Sparse, fit_logistic, sigmoid
from .shingles import beginning_hashes, column_blocks, text_blocks

_U = np.uint64
BUCKET_BITS = 20
BEGINNINGS = (3, 4, 5, 6, 7)


@dataclass(frozen=True)
class ChainSettings:
    """``rows``: at most so many labelled rows are used (those with the
    smallest hashes of their ids); ``columns``: features kept, those whose
    share differs most between rows with and without a category; ``folds``: of
    the out-of-fold predictions."""

    rows: int = 8_000
    columns: int = 3_000
    folds: int = 3


def features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and their beginnings (with repeats), and the text
    each belongs to."""
    whole, parts, offsets = beginning_hashes(texts, BEGINNINGS)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    shift = _U(64 - BUCKET_BITS)
    buckets = np.concatenate([(h >> shift).astype(np.int32) for h in (whole, *parts)])
    return buckets, np.tile(owner, 1 + len(parts))


def _featured(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(_id, labels, _buckets: the distinct buckets of the text)."""
    kinds = ", ".join(f"`{c}` int" for c in labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in column_blocks(batch.column(1)):
                buckets, owner = features(texts)
                key = np.unique(owner.astype(np.int64) << BUCKET_BITS | buckets)
                ends = np.searchsorted(key >> BUCKET_BITS, np.arange(j - i + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(c.slice(i, j - i) for c in batch.columns[2:]), lists],
                                                 ["_id", *labels, "_buckets"])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, {kinds}, _buckets array<int>")


@dataclass(frozen=True)
class Chain:
    """A fitted chain: ``columns`` (ascending buckets in use) and, for each
    category, its weights, its weights on the categories before it, its bias."""

    categories: tuple[str, ...]
    columns: np.ndarray
    models: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    @cached_property
    def places(self) -> np.ndarray:
        """Each bucket's column, -1 for those not in use."""
        place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        place[self.columns] = np.arange(len(self.columns))
        return place

    def predict_column(self, column: pa.Array) -> np.ndarray:
        """Probabilities of a text column, block by block."""
        return np.concatenate([np.zeros((0, len(self.categories))), *(self.predict(texts) for _, _, texts in column_blocks(column))])

    def predict(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probabilities, texts x categories."""
        place = self.places
        out = np.zeros((len(texts), len(self.categories)))
        for i, j in text_blocks(texts):
            buckets, owner = features(texts[i:j])
            column = place[buckets]
            key = np.unique(owner[column >= 0].astype(np.int64) * max(len(self.columns), 1) + column[column >= 0])
            row, column = np.divmod(key, max(len(self.columns), 1))
            for c, (w, before, bias) in enumerate(self.models):
                z = np.bincount(row, w[column], minlength=j - i) + out[i:j, :c] @ before + bias
                out[i:j, c] = sigmoid(z)
        return out


def _pick(x: Sparse, y: np.ndarray, most: int) -> np.ndarray:
    """Columns whose share differs most between the classes of any category."""
    score = np.zeros(x.width)
    for c in range(y.shape[1]):
        pos = y[:, c].sum()
        neg = len(y) - pos
        if pos and neg:
            a, b = x.back(y[:, c]) / pos, x.back(1 - y[:, c]) / neg
            p = (a * pos + b * neg) / len(y)
            score = np.maximum(score, np.abs(a - b) / np.sqrt(p * (1 - p) * (1 / pos + 1 / neg) + 1e-9) * (p * len(y) >= 3))
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(best[score[best] > 2])


def fit_chain(labelled: DataFrame, categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
              settings: ChainSettings = ChainSettings()) -> Chain:
    """Fit the chain to a bounded sample of the labelled rows.

    ``labelled`` holds the id, the text and a 0/1 column per category; rows
    with a null text count as empty, rows with a null label are left out;
    repeated rows count each. The texts, however long, are turned to features on
    the executors; at most ``settings.rows`` rows of features reach the driver.
    Without rows, or with one class, a category is never (or always) given.
    """
    src = labelled.select(labelled[id_col].alias("_id"), labelled[text_col].alias("_text"), *(labelled[c].cast("int").alias(c) for c in categories))
    # the texts become features where they lie; only features are put in order
    got = _featured(src.dropna(subset=list(categories)), categories).orderBy(F.xxhash64("_id"), "_id", "_buckets", *categories).limit(settings.rows).toArrow()
    lists = got.column("_buckets").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    offsets = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
    flat = lists.values.to_numpy()[offsets[0]:offsets[-1]] if len(lists) else np.zeros(0, np.int32)
    y = np.stack([got.column(c).to_numpy() for c in categories], axis=1).astype(float) if len(lists) else np.zeros((0, len(categories)))
    whole = Sparse(flat, offsets - offsets[0], 1 << BUCKET_BITS)
    columns = _pick(whole, y, settings.columns)
    place = np.full(whole.width, -1, dtype=np.int32)
    place[columns] = np.arange(len(columns))
    column = place[whole.columns]
    used = column >= 0
    n = np.bincount(whole.row[used], minlength=len(whole))
    x = Sparse(column[used].astype(np.int64), np.concatenate([[0], np.cumsum(n)]).astype(np.int64), len(columns))
    del whole, column, used, flat, lists, got
    fold = np.arange(len(x)) % settings.folds  # rows are in hash order
    unseen = np.zeros((len(x), len(categories)))
    models = []
    for c in range(len(categories)):
        before = unseen[:, :c]
        for f in range(settings.folds):
            train, test = fold != f, fold == f
            w, wb, bias = fit_logistic(x.rows(train), before[train], y[train, c])
            unseen[test, c] = sigmoid(x.rows(test).dot(w) + before[test] @ wb + bias)
        models.append(fit_logistic(x, before, y[:, c]))
    return Chain(tuple(categories), columns, tuple(models))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """Probabilities of all categories for every whole text.

    Returns one row per input row: the id column, ``p_<category>`` for each
    category and ``toxic`` (the last category's probability is ``threshold`` or
    more). Both classes weigh the same in the fit, so the probabilities hold
    for as many rows with as without the category. Null and empty texts get the
    models' biases; a very long text is a block of its own. Repeated rows and null
    ids stay; other columns are not read; an empty table gives an empty one.
    Nothing is shuffled.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.predict_column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, c]) for c in range(p.shape[1])), pa.array(p[:, -1] >= threshold)],
                                             [id_col, *names, "toxic"])

    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, {', '.join(f'`{n}` double' for n in names)}, toxic boolean")


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """The rows of ``docs``, with all columns, whose last category's
    probability is below ``threshold``. Null and empty texts have the models'
    biases; repeated rows share their fate; null ids and columns of any name are
    kept as they are; an empty table gives an empty one; a very long text is a
    block of its own."""
    at, fields = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(chain.predict_column(batch.column(at))[:, -1] < threshold))

    return docs.mapInArrow(run, fields)
