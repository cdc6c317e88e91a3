"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters
of the lower-cased text (``[0-9a-z\\x80-\\U0010ffff]+``). All texts of a block
are hashed together with a handful of array operations, so that the cost per
word does not depend on how the words are spread over texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
SHINGLE_WORDS = 5

_U = np.uint64
_IS_WORD = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
_BYTE_KEY = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = _U(0x9E3779B97F4A7C15 | 1)
_STEP_BACK = _U(pow(int(_STEP), -1, 1 << 64))
_SHINGLE_STEP = _U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits (two multiply-shift rounds)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x = x * _U(0xA24BAED4963EE407)
    x ^= x >> _U(32)
    return x


def _power(name: str, step: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES * 2)
        out = np.full(size, step, dtype=np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if size <= 1 << 23:
            _powers[name] = have
    return have[:n]


def text_blocks(texts: Sequence[str | None], max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``max_bytes`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= max_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def column_blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, list[str | None]]]:
    """Consecutive slices of a text column of about ``max_bytes`` as lists of
    strings, with their index ranges; one slice is held at a time."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(size) - size) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(column)]
    for i, j in zip(cuts, cuts[1:], strict=False):
        if j > i:
            yield i, j, column.slice(i, j - i).to_pylist()


def _words(texts: Sequence[str | None], lower: bool, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Running hash sums over the bytes of all texts, starts and ends of the
    words, and the offsets of each text's words."""
    enc = [((t.lower() if lower else t).encode("utf-8", "surrogatepass") if t else b"") for t in texts]
    buf = b"\n".join(enc) + b"\n"
    first = np.zeros(len(enc) + 1, dtype=np.int64)
    np.cumsum([len(e) + 1 for e in enc], out=first[1:])
    raw = np.frombuffer(buf, dtype=np.uint8)
    edge = np.diff(table[raw].view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_KEY[raw] * _power("up", _STEP, len(raw)), out=total[1:])
    return total, starts, ends, np.searchsorted(starts, first)


def word_hashes(texts: Sequence[str | None], lower: bool = True, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the offsets of each text's words.

    ``inside`` replaces the rule of what is part of a word by a table over the
    256 byte values.
    """
    total, starts, ends, offsets = _words(texts, lower, _IS_WORD if inside is None else inside)
    return mix((total[ends] - total[starts]) * _power("down", _STEP_BACK, len(total))[starts]), offsets


def beginning_hashes(texts: Sequence[str | None], lengths: Sequence[int]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hashes of all words; for each length those of their first bytes (of
    words that are longer); and the offsets of each text's words. A beginning
    never hashes like a word."""
    total, starts, ends, offsets = _words(texts, True, _IS_WORD)
    down = _power("down", _STEP_BACK, len(total))[starts]
    whole = mix((total[ends] - total[starts]) * down)
    parts = [np.where(ends - starts > n, mix((total[np.minimum(starts + n, ends)] - total[starts]) * down ^ _U(n << 56)), whole) for n in lengths]
    return whole, parts, offsets


def word_spans(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end character offsets of the words of one text (of the
    lower-cased text; the same as of the text itself unless lower-casing
    changes its length)."""
    low = (text or "").lower()
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.concatenate([_IS_WORD[np.minimum(code, 255)], [False]])
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the offsets of each text's runs.

    A text of 1 to ``k - 1`` words has one shingle, of all its words; a text
    without words has none.
    """
    n = np.diff(offsets)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_off = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(count, out=out_off[1:])
    out = np.empty(out_off[-1], dtype=np.uint64)
    weight = [_U(pow(int(_SHINGLE_STEP), i + 1, 1 << 64)) for i in range(k)]
    short = np.flatnonzero((n > 0) & (n < k))
    long_slot = np.ones(len(out), dtype=bool)
    long_slot[out_off[short]] = False
    if len(words) >= k:
        runs = len(words) - k + 1
        acc = words[:runs] * weight[0]
        for i in range(1, k):
            acc += words[i:i + runs] * weight[i]
        left = np.repeat(offsets[1:], n)[:runs] - np.arange(runs)
        out[long_slot] = acc[left >= k]
    for d in short:
        w = words[offsets[d]:offsets[d + 1]]
        out[out_off[d]] = sum(int(x) * int(y) for x, y in zip(w, weight, strict=False)) & 0xFFFFFFFFFFFFFFFF
    return mix(out ^ _U(k)), out_off


def counted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, how often each occurs,
    and the offsets of each text's distinct values."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(v)))
    return v[at], counts, np.searchsorted(o[at], np.arange(len(offsets)))


def multiset_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets (ascending distinct values, counts):
    sum of minima over sum of maxima; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    high = int(a[1].sum()) + int(b[1].sum()) - low
    return low / high if high else 0.0
