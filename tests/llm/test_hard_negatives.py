import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ragloom.llm import hard_negatives as H
from ragloom.llm import queries

from .helpers import EXTRA, EXTRA_ROW
from .test_oracle import duck_rows

SF = "/root/testdata/sf0.01"


def plain(rows, divisor=50):
    """The whole definition over ``(id, label, vector)`` rows."""
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in whole) < 2**61:
            seen.add((i, label, whole))
    out = set()
    for i, label, v in seen:
        if i % divisor:
            continue
        scored = [(sum(map(int.__mul__, v, w)), j, m) for j, m, w in seen if len(w) == len(v)]
        for score, positive in sorted({(s, j) for s, j, m in scored if j != i and m == label}, key=lambda x: (-x[0], x[1]))[:5]:
            fits = sorted({(s, j) for s, j, m in scored if m != label and 50 * score <= 100 * s <= 95 * score}, key=lambda x: (-x[0], x[1]))
            out |= {(i, positive, k + 1, j, score, s) for k, (s, j) in enumerate(fits[:3])}
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def made(seed, n, d=6):
    rng = random.Random(seed)
    base = [[rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(d)] for _ in range(4)]
    return [(i, rng.randint(0, 3), [x + rng.choice([0, 0, 0.1, -0.3]) for x in rng.choice(base)]) for i in range(n)]


EDGE = [(None, 1, [1.0] * 6), (1000, None, [1.0] * 6), (1001, 1, None), (1002, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, 1, [float("nan")] * 6),
        (1004, 2, [float("inf")] + [0.0] * 5), (1005, 2, [1e30] * 6), (1050, 1, [0.0] * 6), (1100, 1, [0.5, 0.5]), (1101, 1, [0.5, 0.25]), (1102, 2, [0.25, 0.25]),
        (1150, 0, []), (1151, 0, []), (1152, 1, []), (1200, 3, [-1.0] * 6), (50, 0, [0.7] * 6), (50, 0, [0.7] * 6), (51, 0, [0.2] * 6), (51, 1, [0.4] * 6),
        (1250, 2, [3e3] * 6), (1251, 2, [3e3] * 5 + [0.0]), (1252, 3, [2e3] * 6)]


@pytest.mark.parametrize("block", [1, 4000, 16 << 20])
def test_equal_to_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK_BYTES", block if block > 1 else 400)
    rows = made(1, 160) + EDGE + EDGE[-3:]
    kind = "vec_id bigint, label int, embedding array<float>, " + EXTRA.replace("id int", "v int").replace("node bigint", "d bigint").replace("u bigint", "h bigint")
    df = spark.createDataFrame([(*r, *EXTRA_ROW) for r in rows], kind).repartition(3)
    want = plain(rows)
    assert len(want) > 20
    assert got(H.mine(df)) == want


def test_tables_without_results(spark):
    kind = "vec_id bigint, label int, embedding array<float>"
    for rows in ([], [(1, 1, [0.5])], [(50, 1, [0.5])], [(50, 1, [0.5]), (1, 1, [0.5])]):
        assert got(H.mine(spark.createDataFrame(rows, kind))) == []


def test_query_against_sql(spark):
    names = ["anchor_id", "negative_id", "negative_score", "positive_id", "positive_score", "rank"]
    rows = sorted(tuple(r[n] for n in names) for r in queries.op12_hard_negatives(spark, SF).collect())
    assert rows and rows == duck_rows("op12_hard_negatives", SF)


@settings(max_examples=150, deadline=None)
@given(st.tuples(*[st.integers(0, 40)] * 3), st.integers(1, 8), st.integers(0, 2**30), st.integers(0, 2**32 - 1))
def test_strassen_equals_the_plain_product(shape, leaf, high, seed):
    m, k, n = shape
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-high - 1, high + 1, (m, k)), rng.integers(-high - 1, high + 1, (n, k))
    assert (H.strassen(a, b, leaf) == a @ b.T).all() and H.strassen(a, b, leaf).shape == (m, n)


def test_strassen_wraps_back():
    """Sums on the way may leave 64 bits; the result is still exact."""
    a = np.full((4, 4), (1 << 30) - 1, dtype=np.int64)
    a[:, 1::2] *= -1
    want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in a[:, ::-1]] for r in a]
    assert H.strassen(a, np.ascontiguousarray(a[:, ::-1]), 1).tolist() == want


@given(st.integers(-(2**62), 2**62), st.sampled_from([(50, 95), (0, 100), (1, 1)]))
def test_window(score, ends):
    low, high = ends
    a, b = H.window(np.array([score]), low, high)
    assert int(a[0]) == -(-low * score // 100) and int(b[0]) == high * score // 100


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.integers(0, 5)), max_size=40), st.integers(1, 4), st.integers(0, 40))
def test_heaps_merge_in_any_order(entries, size, cut):
    whole, parts = H.Heaps.empty(size), H.Heaps.empty(size)
    arrays = [np.array(x, dtype=np.int64) for x in zip(*entries, strict=True)] or [np.zeros(0, dtype=np.int64)] * 3
    whole.merge(*arrays)
    for part in (slice(cut, None), slice(0, cut)):
        parts.merge(*(x[part] for x in arrays))
    want = [e for h in range(4) for e in sorted({(-s, r) for x, s, r in entries if x == h})[:size]]
    for heaps in (whole, parts):
        assert list(zip((-heaps.score).tolist(), heaps.row.tolist(), strict=True)) == want


def test_tiles_of_any_size_find_the_same(monkeypatch):
    rows = [r for r in made(4, 120) if len(r[2]) == 6]
    table = pa.table({"id": [r[0] for r in rows], "label": pa.array([r[1] for r in rows], pa.int64()), "v": pa.array([r[2] for r in rows], pa.list_(pa.float32()))})
    anchors = table.append_column("h", table.column("id")).slice(0, 30)
    found = []
    for tile in ((3, 7), (512, 2048)):
        monkeypatch.setattr(H, "TILE", tile)
        found.append(H.positives_in(anchors, table, 5).sort_by([("id", "ascending"), ("score", "descending"), ("positive", "ascending")]))
    assert found[0] == found[1] and found[0].num_rows == 150
