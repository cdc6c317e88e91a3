"""Benchmark decontamination: SimHash item-sized windows, multi-index Hamming
blocks, exact weighted-shingle similarity.

A window of a document is as long as the item it is held against. Windows that
share no shingle with an item have similarity 0, so only windows around shared
shingles are fingerprinted, and only items with a shared shingle are asked. The
fingerprint of a window (256 signs of sums over its shingles) is looked up in an
index of the items' fingerprints cut into 32 blocks of 8 bits: if two
fingerprints differ in at most R bits, at most R // 3 blocks differ in three or
more, so all the other blocks lie in the ball of two bits around the item's. A
table per block gives the items whose ball a byte falls into; what is found in
enough tables is within the radius or is dropped by the whole distance. Of
unrelated fingerprints about one in a thousand is found in 12 of 32 tables.

The distance follows the similarity where shingles occur once. A window or item
that repeats a shingle is not held to the radius but to the bound that the
number of shared places sets on the similarity, which no match fails.
Candidates are verified by the exact similarity of the two multisets of shingles
(every occurrence weighs one).

Items are handled in blocks of bounded size; each block is sent to the
executors and all documents are held against it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shingles import SHINGLE_WORDS, counted, mix, multiset_similarity, shingle_hashes, text_blocks, word_hashes

BLOCK_CHARS = 2_000_000
_BYTES = 32
_BALL = 2  # bits around an item's block
_POP8 = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_TABLE_BITS = 20
_U = np.uint64


@dataclass(frozen=True)
class Match:
    """``radius``: bits in which fingerprints may differ (two windows of
    similarity 0.8 differ in about 39 of 256 bits, standard deviation 6);
    ``least``: similarity from which a window counts as the item."""

    radius: int = 62
    least: float = 0.8


def _signs(shingles: np.ndarray) -> np.ndarray:
    """256 signs (+1, -1) of each shingle."""
    keys = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
    four = np.stack([mix(shingles ^ _U(k)) for k in keys], axis=1)
    return np.unpackbits(four.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def window_fingerprints(shingles: np.ndarray, size: int) -> np.ndarray:
    """SimHash fingerprints (32 bytes each) of all windows of ``size`` shingles."""
    total = np.zeros((len(shingles) + 1, 8 * _BYTES), dtype=np.int32)
    np.cumsum(_signs(shingles), axis=0, out=total[1:])
    return np.packbits(total[size:] - total[:-size] > 0, axis=1)


class ItemIndex:
    """Shingles, fingerprints and Hamming tables of a bounded block of items."""

    def __init__(self, ids: list, texts: list[str | None], match: Match):
        self.match = match
        words, offsets = word_hashes(texts)
        n = np.diff(offsets)
        self.ids, self.items = [], []
        for i in np.flatnonzero(n > 0):
            k = int(min(SHINGLE_WORDS, n[i]))
            run, _ = shingle_hashes(words[offsets[i]:offsets[i + 1]], np.array([0, n[i]]), k)
            values, counts, _ = counted(run, np.array([0, len(run)]))
            self.ids.append(ids[i])
            self.items.append((k, len(run), values, counts, window_fingerprints(run, len(run))[0]))
        self.lookup = {}
        for k in sorted({x[0] for x in self.items}):
            own = [j for j, x in enumerate(self.items) if x[0] == k]
            values = np.concatenate([self.items[j][2] for j in own])
            owner = np.repeat(own, [len(self.items[j][2]) for j in own])
            order = np.argsort(values, kind="stable")
            bits = np.zeros(1 << _TABLE_BITS, dtype=bool)
            bits[(values >> _U(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.lookup[k] = values[order], owner[order], bits
        # per shingle length and window size: items, fingerprints, and for each
        # block and byte value the items whose block is within the ball
        self.hamming = {}
        for key in {(x[0], x[1]) for x in self.items}:
            own = np.array([j for j, x in enumerate(self.items) if x[:2] == key])
            prints = np.stack([self.items[j][4] for j in own])
            ball = _POP8[prints.T[:, None, :] ^ np.arange(256, dtype=np.uint8)[None, :, None]] <= _BALL
            self.hamming[key] = own, prints, ball
        self.repeats = np.array([x[3].max() > 1 for x in self.items], dtype=bool)
        self.asked = self.passed = 0

    def _near(self, prints: np.ndarray, key: tuple[int, int], among: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, items and distances of all pairs within the radius, for the
        items ``among`` those of one size."""
        own, items, ball = self.hamming[key]
        at = np.searchsorted(own, among)
        found = np.zeros((len(prints), len(at)), dtype=np.uint8)
        for b in range(_BYTES):
            found += ball[b][:, at][prints[:, b]]
        w, j = np.nonzero(found >= _BYTES - self.match.radius // (_BALL + 1))
        self.asked, self.passed = self.asked + found.size, self.passed + len(w)
        far = _POP8[prints[w] ^ items[at[j]]].sum(axis=1, dtype=np.int64)
        ok = far <= self.match.radius
        return w[ok], among[j[ok]], far[ok]

    def _bounded(self, run: np.ndarray, first: int, end: int, span: int, prints: np.ndarray, key: tuple[int, int], among: np.ndarray,
                 again: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs that are not held to the radius (the window or the item
        repeats a shingle), as far as the number of the window's places whose
        shingle the item has allows the similarity asked for."""
        own, items, _ = self.hamming[key]
        out = []
        for j in among.tolist():
            open_windows = np.ones(end - first, dtype=bool) if self.repeats[j] else again
            if not open_windows.any():
                continue
            inside = np.concatenate([[0], np.cumsum(np.isin(run[first:end + span - 1], self.items[j][2]))])
            shared = inside[span:] - inside[:-span]
            w = np.flatnonzero(open_windows & (shared >= self.match.least * (span + self.items[j][1] - shared) - 1e-9))
            out.append((w, np.full(len(w), j), _POP8[prints[w] ^ items[np.searchsorted(own, j)]].sum(axis=1, dtype=np.int64)))
        return out

    def _document(self, run: np.ndarray, at: np.ndarray, k: int) -> dict[int, tuple]:
        """Best window per item of one document: ``run`` its shingles, ``at``
        the places of those that some item has."""
        values, owner, _ = self.lookup[k]
        lo, hi = np.searchsorted(values, run[at], "left"), np.searchsorted(values, run[at], "right")
        place = np.repeat(at, hi - lo)
        item = owner[np.repeat(lo, hi - lo) + np.arange(len(place)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
        best: dict[int, tuple] = {}
        # the first place at or after each one whose shingle comes again, as the place of its repeat
        after = np.full(len(run) + 1, len(run) + 1)
        order = np.argsort(run, kind="stable")
        same = run[order][1:] == run[order][:-1]
        after[order[:-1][same]] = order[1:][same]
        after = np.minimum.accumulate(after[::-1])[::-1]
        starts: dict[int, list] = {}  # window sizes: the places their windows must cover
        for j in np.unique(item):
            starts.setdefault(self.items[j][1], []).append(place[item == j])
        for size, places in starts.items():
            span = min(size, len(run))  # a document shorter than the item is one window
            key = (k, size)
            among = np.unique(item[np.isin(item, self.hamming[key][0])])
            covered = np.unique(np.concatenate(places))
            first = np.maximum(covered - span + 1, 0)
            last = np.minimum(covered, len(run) - span)
            # stretches of neighbouring window starts
            cut = np.flatnonzero(first[1:] > last[:-1] + 1) + 1
            for f, e in zip(first[np.concatenate([[0], cut])], last[np.concatenate([cut - 1, [len(covered) - 1]])], strict=True):
                prints = window_fingerprints(run[f:e + span], span)
                again = after[f:e + 1] < np.arange(f, e + 1) + span
                pairs = [self._near(prints, key, among), *self._bounded(run, f, e + 1, span, prints, key, among, again)]
                w, items, far = (np.concatenate(x) for x in zip(*pairs, strict=True))
                for i in np.lexsort((w, far)):
                    j, start = int(items[i]), int(f + w[i])
                    if j in best and (best[j][0] == 1.0 and (far[i] > 0 or start >= best[j][2])):
                        continue
                    window = counted(run[start:start + span], np.array([0, span]))[:2]
                    sim = multiset_similarity(window, self.items[j][2:4])
                    if sim >= self.match.least and (j not in best or (-sim, start) < (-best[j][0], best[j][2])):
                        best[j] = (sim, int(far[i]), start, start + span + k - 1)
        return best

    def find(self, texts: list[str | None]) -> list[dict[int, tuple]]:
        """For each text: item index -> (similarity, distance, first word, end
        word) of the best window; of equally similar ones the first."""
        out: list[dict[int, tuple]] = [{} for _ in texts]
        for i, j in text_blocks(texts):
            words, offsets = word_hashes(texts[i:j])
            for k, (values, _, bits) in self.lookup.items():
                run, off = shingle_hashes(words, offsets, k)
                maybe = np.flatnonzero(bits[(run >> _U(64 - _TABLE_BITS)).astype(np.int64)])
                if not len(maybe):
                    continue
                there = np.minimum(np.searchsorted(values, run[maybe]), len(values) - 1)
                at = maybe[values[there] == run[maybe]]
                doc = np.searchsorted(off, at, "right") - 1
                for d in np.unique(doc):
                    if offsets[d + 1] - offsets[d] >= k:
                        out[i + d].update(self._document(run[off[d]:off[d + 1]], at[doc == d] - off[d], k))
        return out


def _indexes(items: DataFrame, id_col: str, text_col: str, match: Match, block_chars: int) -> Iterator[ItemIndex]:
    """One index per block of items; a block holds about ``block_chars``
    characters. The plan keeps one pickled index per block."""
    src = items.select(items[id_col].alias("_id"), items[text_col].alias("_text")).where(F.col("_text").isNotNull())
    chars = src.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    for b in range(blocks):
        part = src.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == b) if blocks > 1 else src
        rows = sorted(part.collect(), key=lambda r: (r["_id"] is None, r["_id"], r["_text"]))
        yield ItemIndex([r["_id"] for r in rows], [r["_text"] for r in rows], match)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", match: Match = Match(), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All documents that hold a benchmark item.

    Returns one row per input row and item with a window of similarity
    ``match.least`` or more: the id column, the item column, ``similarity``,
    ``hamming`` (bits between the fingerprints), ``word_start`` and
    ``word_end`` (the best window, in words; the first of equally good ones).
    Items of one to four words are one shingle and found word for word; items
    without words (null and empty ones) are found nowhere. A document shorter
    than an item is one window. Null and empty texts hold nothing. Repeated
    rows and items, and null ids, give rows of their own; ids are of any simple
    type. Other columns are not read; empty tables give an empty one. A very
    long text is taken whole: its shingles, and the fingerprints of one stretch
    around shared shingles, are in memory at a time. Nothing is shuffled.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind, item_kind = src.schema["_id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    arrow_kind = to_arrow_type(items.schema[item_col].dataType)

    def against(index: ItemIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    part = batch.slice(i, 2048)
                    rows = [(d, j, *x) for d, found in enumerate(index.find(part.column(1).to_pylist())) for j, x in sorted(found.items())]
                    cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(cols[0], pa.int64())), pa.array([index.ids[j] for j in cols[1]], arrow_kind),
                         pa.array(cols[2], pa.float64()), *(pa.array(c, pa.int64()) for c in cols[3:])],
                        [id_col, item_col, "similarity", "hamming", "word_start", "word_end"])

        return src.mapInArrow(run, f"`{id_col}` {kind}, `{item_col}` {item_kind}, similarity double, hamming bigint, word_start bigint, word_end bigint")

    return reduce(DataFrame.unionAll, [against(x) for x in _indexes(items, item_col, item_text_col, match, block_chars)])


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          match: Match = Match(), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no item. Null and empty
    texts hold none; repeated rows share their fate; null ids and columns of any
    name are kept as they are; empty tables and empty benchmarks are no special
    case; very long texts as in :func:`matches`."""
    at, fields = docs.columns.index(text_col), docs.schema

    def without(rows: DataFrame, index: ItemIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    part = batch.slice(i, 2048)
                    yield part.filter(pa.array([not found for found in index.find(part.column(at).to_pylist())], pa.bool_()))

        return rows.mapInArrow(run, fields)

    return reduce(without, _indexes(items, item_col, item_text_col, match, block_chars), docs)
