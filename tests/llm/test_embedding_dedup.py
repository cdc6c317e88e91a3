import numpy as np

from ragloom.llm import embedding_dedup as E
from ragloom.llm import queries


def plain(rows, least=0.9):
    """Links and components of {id: vector}, all pairs."""
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= least
    np.fill_diagonal(link, False)
    root = np.arange(len(ids))
    while True:
        new = np.minimum(root, np.where(link, root[None, :], len(ids)).min(axis=1, initial=len(ids)))
        if (new == root).all():
            break
        root = new
    return {i: (int(link[k].sum()), ids[root[k]]) for k, i in enumerate(ids)}


def got(df, **kw):
    return {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df, **kw).collect() if r.vec_id is not None}


def clustered(seed=0, n=1500, d=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n, d))
    rows = [c for c in centres]
    for k in range(300):  # pairs from just below to far above the threshold
        rows.append(centres[k] + rng.standard_normal(d) * rng.uniform(0.1, 0.5))
    rows += [centres[0] + rng.standard_normal(d) * 0.15 for _ in range(300)]
    return {i: v.astype(np.float32).tolist() for i, v in enumerate(rows)}


def test_recall_and_precision_against_brute_force(spark):
    rows = clustered()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows.items()], "vec_id bigint, embedding array<float>, _v string, _node int")
    want, have = plain(rows), got(df, index=E.Index(bucket=64, block=100))
    assert all(have[i][0] <= want[i][0] for i in want)
    assert sum(h[0] for h in have.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert sum(have[i] == want[i] for i in want) >= 0.97 * len(want)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    assert {r.vec_id: (r.n_links, r.component_id) for r in queries.op8_embedding_dedup(spark, sf).collect()} == plain(rows)


def test_edge_rows(spark):
    kind = "vec_id bigint, embedding array<float>"
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [-3.0, 0.5, 1.0]
    rows = [(1, a), (2, [2.0, 4.0, 6.0]), (3, a), (3, a), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 3.0]), (8, [nan, 1.0, 1.0]),
            (9, [inf, 1.0, 1.0]), (10, b), (11, [1.0, 2.0]), (12, [1.0, 2.0]), (None, a), (None, None), (13, [1e30, 2e30, 3e30]), (14, [-0.0, 0.0, 0.0])]
    all_rows = E.near_duplicates(spark.createDataFrame(rows, kind)).collect()
    have = {r.vec_id: (r.n_links, r.component_id) for r in all_rows if r.vec_id is not None}
    assert have == {1: (3, 1), 2: (3, 1), 3: (3, 1), 13: (3, 1), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10),
                    11: (1, 11), 12: (1, 11), 14: (0, 14)}
    assert [(r.n_links, r.component_id, r.kept) for r in all_rows if r.vec_id is None] == [(0, None, True)] * 2
    assert E.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    assert got(spark.createDataFrame([(1, None)], kind)) == {1: (0, 1)}


def test_rotation_gives_balanced_close_codes():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 48)) * np.linspace(0.2, 2, 48)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, matrix = E.learn_rotation(x, 30, 0)
    z = (x - mean) @ matrix
    assert np.abs((z >= 0).mean(axis=0) - 0.5).max() < 0.1
    _, raw = E.learn_rotation(x, 0, 0)
    loss = lambda m: (((x - mean) @ m - np.where((x - mean) @ m >= 0, 1, -1)) ** 2).sum()
    assert loss(matrix) < loss(raw) and np.allclose(matrix.T @ matrix, np.eye(48), atol=1e-8)


def around_mean(n, cosine, seed, d=64):
    """Unit vectors whose average cosine is ``cosine``, and a partner of each at 0.9."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(np.sqrt(cosine) * np.eye(d)[:1] + np.sqrt(1 - cosine) * unit(rng.standard_normal((n, d))))
    off = rng.standard_normal((n, d))
    off = unit(off - (off * x).sum(axis=1, keepdims=True) * x)
    return x, 0.9 * x + np.sqrt(0.19) * off


def test_recall_with_a_common_mean_and_long_keys():
    for cosine in (0, 0.5, 0.7):
        left, right = around_mean(4000, cosine, 3)
        for rows in (50_000, 5_000_000):
            models, bits, tables = E.plan_tables(left, rows, E.Index())
            shared = (E._keys(left, models, bits, tables) == E._keys(right, models, bits, tables)).any(axis=1)
            assert bits == E.Index().bits(rows) and shared.mean() >= 0.97, (cosine, rows, tables)


def test_links_around_a_common_mean_equal_brute_force(spark):
    left, right = around_mean(1000, 0.7, 4)
    rows = {i: v.tolist() for i, v in enumerate(np.concatenate([left, right]))}
    want = plain(rows, 0.9 - 1e-9)
    have = got(spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<double>"), index=E.Index(least=0.9 - 1e-9, bucket=8))
    assert all(have[i][0] <= want[i][0] for i in want)
    assert sum(h[0] for h in have.values()) >= 0.97 * sum(w[0] for w in want.values())
