import math

import numpy as np
from pyspark.sql import functions as F

from ragloom.llm import queries, toxicity
from ragloom.llm.linear import Sparse, fit_logistic, sigmoid

from .helpers import DOC_ROWS, documents, empty_documents, prose

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(4)) == 0
    rows = docs.join(labels.where(~odd), "doc_id").withColumn("insult", (F.col("text").rlike("(?i)idiot|loser") & (F.col("toxic") == 1)).cast("int"))
    chain = toxicity.fit_chain(rows, ["insult", "toxic"])
    got = toxicity.score(docs, chain).join(labels.where(odd).withColumnRenamed("toxic", "label"), "doc_id").collect()
    caught = sum(r.toxic for r in got if r.label == 1)
    wrong = sum(r.toxic for r in got if r.label == 0)
    # about a tenth of this table's toxic labels are on texts without any sign
    assert caught >= 0.85 * sum(r.label for r in got) and wrong <= 0.02 * len(got)


def test_chain_uses_earlier_categories(spark):
    rows = spark.createDataFrame([(i, f"alpha w{i}" if i % 2 else f"beta w{i}", i % 2, i % 2) for i in range(300)], "doc_id bigint, text string, a int, b int")
    chain = toxicity.fit_chain(rows, ["a", "b"])
    assert len(chain.models[0][1]) == 0 and len(chain.models[1][1]) == 1 and chain.models[1][1][0] > 0
    p = chain.predict(["alpha", "beta", None])
    assert p[0].min() > 0.5 > p[1].max()


def test_edge_rows(spark):
    label = [(i, prose(30, i) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)] + [(None, "x", 1), (500, None, 0), (501, "y", None)]
    chain = toxicity.fit_chain(spark.createDataFrame(label, "doc_id bigint, text string, toxic int"), ["toxic"])
    rows = [*DOC_ROWS, (50, "a vile thing"), (51, "VILE, " * 2000)]
    got = toxicity.score(documents(spark, rows), chain).collect()
    assert len(got) == len(rows) and all(0 <= r.p_toxic <= 1 for r in got)
    toxic = {r.doc_id for r in got if r.toxic}
    assert toxic >= {50, 51} and not toxic & {3, 4, 5, 8, 9, 10, 11, None}
    kept = toxicity.keep_clean(documents(spark, rows), chain)
    assert kept.count() == sum(not r.toxic for r in got) and kept.columns == documents(spark).columns
    assert toxicity.score(empty_documents(spark), chain).collect() == []


def test_without_labels_or_with_one_class_nothing_is_toxic(spark):
    kind = "doc_id bigint, text string, toxic int"
    for rows in ([], [(1, "a b", 0), (2, "c", 0)]):
        chain = toxicity.fit_chain(spark.createDataFrame(rows, kind), ["toxic"])
        assert not any(r.toxic for r in toxicity.score(documents(spark), chain).collect())


def test_query_covers_all_documents(spark):
    rows = queries.op6_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(min(r.p_insult, r.p_contempt, r.p_toxic) >= 0 for r in rows)


def plain_probabilities(chain, text):
    """The chain over one text, number by number."""
    buckets = {int(b) for b in toxicity.features([text])[0]}
    place = {int(b): i for i, b in enumerate(chain.columns)}
    out = []
    for weights, before, bias in chain.models:
        z = bias + sum(weights[place[b]] for b in buckets if b in place) + sum(p * w for p, w in zip(out, before, strict=True))
        out.append(1 / (1 + math.exp(-max(-35.0, min(35.0, z)))))
    return out


def test_scores_equal_a_plain_chain(spark):
    """Every document's probabilities, and what the pipeline keeps, against the
    chain written out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    chain = queries.toxicity_chain(spark, docs, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.score(docs, chain).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_probabilities(chain, texts[r.doc_id])
        assert np.allclose([r.p_insult, r.p_contempt, r.p_toxic], want, atol=1e-9) and r.toxic == (want[-1] >= 0.4)
    kept = {r.doc_id for r in toxicity.keep_clean(docs, chain).select("doc_id").collect()}
    assert kept == {r.doc_id for r in rows if not r.toxic}


def test_later_models_learn_from_predictions_of_unseen_rows(spark):
    """The chain's fit redone with plain loops: rows in the order of their ids'
    hashes, three folds, each row's earlier probabilities from a model that has
    not seen it."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        a = int(rng.random() < 0.4)
        b = int(rng.random() < (0.8 if a else 0.2))
        rows.append((i, " ".join(["vile"] * a + ["base"] * b + [f"w{rng.integers(30)}" for _ in range(6)] + (["vile"] if rng.random() < 0.1 else [])), a, b))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, a int, b int")
    chain = toxicity.fit_chain(df.repartition(4), ["a", "b"])
    order = [r.doc_id for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    place = {int(c): k for k, c in enumerate(chain.columns)}
    sets = [sorted({place[int(x)] for x in toxicity.features([rows[i][1]])[0] if int(x) in place}) for i in order]
    y = np.array([rows[i][2:] for i in order], dtype=float)

    def sparse(keep):
        own = [sets[i] for i in keep]
        return Sparse(np.array([c for s in own for c in s], dtype=np.int64), np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int64), len(place))

    unseen = np.zeros((240, 2))
    for c in (0, 1):
        for f in range(3):
            train, test = [i for i in range(240) if i % 3 != f], [i for i in range(240) if i % 3 == f]
            w, before, bias = fit_logistic(sparse(train), unseen[train, :c], y[train, c])
            unseen[test, c] = sigmoid(sparse(test).dot(w) + unseen[test, :c] @ before + bias)
        w, before, bias = fit_logistic(sparse(range(240)), unseen[:, :c], y[:, c])
        assert np.allclose(w, chain.models[c][0], atol=1e-6) and np.allclose(before, chain.models[c][1], atol=1e-6) and abs(bias - chain.models[c][2]) < 1e-6
    assert chain.models[1][1][0] > 0
