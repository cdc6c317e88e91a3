"""Points stored in place, models by alias, sketches, extractors, batch scorer."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ragloom.operators import extractors as X
from ragloom.operators import metrics as M
from ragloom.operators import ml as ML
from ragloom.operators import retrieval as R
from ragloom.operators.stores import ModelStore, PointStore, score_by_alias


def fresh():
    return os.path.join(tempfile.mkdtemp(prefix="ragloom-store-"), "t")


def files_of(path):
    return {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("bucket=")}


def test_upsert_rewrites_only_the_buckets_it_is_sent(spark):
    store = PointStore(spark, fresh(), buckets=16)
    assert store.upsert(spark.createDataFrame([], "point_id string, v int")) == 0
    store.upsert(spark.createDataFrame([(f"p{i}", 1) for i in range(200)], "point_id string, v int"))
    before = files_of(store.path)
    n = store.upsert(spark.createDataFrame([("p3", 2), ("p3", 5), ("p7", 2), ("new", 2)], "point_id string, v int"))
    after = files_of(store.path)
    changed = {b for b in after if before.get(b) != after[b]}
    assert len(changed) == n <= 3
    got = {r["point_id"]: r["v"] for r in store.read().collect()}
    assert len(got) == 201 == store.read().count() and got["p3"] == 5 and got["p7"] == got["new"] == 2 and got["p0"] == 1
    store.recreate(spark.createDataFrame([("only", 9)], "point_id string, v int"))
    assert [tuple(r) for r in store.read().collect()] == [("only", 9)]


def test_model_by_alias_scores_as_before_saving(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(x), "a" if x > 0 else "b", int(x + rng.normal(scale=0.3) > 0), "train" if i % 3 else "test") for i, x in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "id int, x double, kind string, approved int, split string")
    runs, models = ML.run_experiments(df, "approved", ["x"], ["kind"], configs=[ML.ModelConfig("logistic_regression", {"C": c}) for c in (0.01, 1.0)])
    store = ModelStore(spark, fresh())
    for version, model in enumerate(models.values(), 1):
        store.save("m", version, model)
    aliases = spark.createDataFrame([("m", "production", 1), ("m", "staging", 2)], "name string, alias string, version int")
    for alias, model in zip(("production", "staging"), models.values(), strict=True):
        now = {r["id"]: (r["decision"], r["probability_positive"]) for r in score_by_alias(store, aliases, "m", alias, df).collect()}
        assert now == {r["id"]: (r["decision"], r["probability_positive"]) for r in ML.score(model, df).collect()}
    moved = ML.set_alias(aliases, spark.createDataFrame([("m", "production", 2)], "name string, alias string, version int"))
    now = {r["id"]: r["probability_positive"] for r in score_by_alias(store, moved, "m", "production", df).collect()}
    assert now == {r["id"]: r["probability_positive"] for r in ML.score(list(models.values())[1], df).collect()}
    with pytest.raises(KeyError):
        store.load(aliases, "m", "nobody")
    with pytest.raises(Exception, match="already exists"):
        store.save("m", 1, list(models.values())[0])


def test_models_score_in_a_session_that_has_observed_a_write(spark):
    from pyspark.sql import Observation

    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(fresh())
    assert seen.get["n"] == 5
    rows = [(i, float(i % 10), int(i % 10 > 4), "train" if i % 3 else "test", i // 10 % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, x double, approved int, split string, fold int")
    configs = [ML.ModelConfig("logistic_regression", {"C": 1.0}), ML.ModelConfig("random_forest", {"numTrees": 3, "maxDepth": 2}),
               ML.ModelConfig("gradient_boosting", {"maxIter": 2, "maxDepth": 2})]
    runs, models = ML.run_experiments(df, "approved", ["x"], configs=configs)
    assert [r["accuracy"] for r in runs.orderBy("pos").collect()] == [1.0, 1.0, 1.0]
    for model in models.values():
        assert {(r["approved"], r["decision"]) for r in ML.score(model, df).collect()} == {(1, "approved"), (0, "rejected")}
    assert [r["accuracy"] for r in ML.cross_validate(df, "approved", ["x"]).orderBy("fold").collect()] == [1.0, 1.0]


def test_merged_sketches_stay_within_the_rank_error(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(3, 1, 20_000), np.full(5_000, 42.0)])
    hours = rng.integers(0, 24, len(values))
    df = spark.createDataFrame(pd.DataFrame({"hour": hours, "v": values})).repartition(5)
    hourly = M.quantile_sketch(df, "v", ["hour"])
    whole = M.sketch_summary(M.merge_sketches(hourly)).first()
    assert whole["n"] == len(values) and hourly.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    ordered = np.sort(values)
    for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        low, high = np.searchsorted(ordered, whole[name], "left") / len(values), np.searchsorted(ordered, whole[name], "right") / len(values)
        assert low - 0.015 <= q <= high + 0.015
    small = M.sketch_summary(M.quantile_sketch(spark.range(1, 101), "id")).first()
    assert (small["n"], small["p50"], small["p99"]) == (100, 50.0, 99.0)


def test_extractors_give_many_rows_and_errors(spark):
    rows = [(1, "txt", b"a\n\n  b \nc"), (2, "json", b'[{"x": 1, "y": "z"}, {"x": null}]'), (3, "json", b'[{"x": 1}'), (4, "pdf", b"%PDF"),
            (5, "txt", b"\xff\xfe broken"), (6, "txt", b""), (7, "txt", None), (8, None, b"x"), (9, "json", b'[{"x": 1}, 5]')]
    got = X.extract_rows(spark, spark.createDataFrame(rows, "id int, kind string, content binary")).collect()
    by_id = {}
    for r in sorted(got, key=lambda r: (r["id"], r["part"])):
        by_id.setdefault(r["id"], []).append((r["field"], r["value"], r["error"]))
    assert by_id == {
        1: [("line", "a", None), ("line", "b", None), ("line", "c", None)], 2: [("x", "1", None), ("y", "z", None), ("x", "null", None)],
        3: [(None, None, "JSONDecodeError")], 4: [(None, None, "no extractor for pdf")], 5: [(None, None, "UnicodeDecodeError")],
        8: [(None, None, "no extractor for None")], 9: [("x", "1", None), (None, None, "AttributeError")]}


def test_scorer_loads_its_model_once_a_worker(spark):
    spec = '{"power": 2.0}'
    pairs = spark.createDataFrame([("big cat", "a cat"), ("big cat", "BIG cat"), ("", "x"), (None, "x"), ("cat", None)] * 50, "q string, d string").coalesce(1)
    score = R.model_scorer(spec)
    got = {(r["q"], r["d"]): r["s"] for r in pairs.select("q", "d", score(F.col("q"), F.col("d")).alias("s")).collect()}
    assert got == {("big cat", "a cat"): 0.5, ("big cat", "BIG cat"): 1.0, ("", "x"): 0.0, (None, "x"): 0.0, ("cat", None): 0.0}
    R._pair_model.cache_clear()
    start = len(R.LOADED)
    for _ in range(3):
        score.func(pd.Series(["a b"]), pd.Series(["b"]))
    assert R.LOADED[start:] == [spec]
