import math

from pyspark.sql import functions as F

from ragloom.operators import evals as E
from ragloom.operators import graph as G
from ragloom.operators import lm as LM


def test_lenient_json(spark):
    raws = [
        (1, '{"tasks": [{"owner": "a", "task": "t"}], "decisions": []}'),
        (2, 'Sure:\n```json\n{"tasks": [], "decisions": ["d"]}\n```'),
        (3, 'text {"tasks": [{"owner": "b", "task": "{nested}"}]} more'),
        (4, "no json at all"),
        (5, '{"tasks": [} broken'),
    ]
    df = spark.createDataFrame(raws, "id int, raw string")
    parsed, valid = E.lenient_json(F.col("raw"))
    got = {r["id"]: (r["v"], r["p"]) for r in df.select("id", valid.alias("v"), parsed.alias("p")).collect()}
    assert got[1][0] and got[1][1]["tasks"][0]["owner"] == "a"
    assert got[2][0] and got[2][1]["decisions"] == ["d"]
    assert got[3][0] and got[3][1]["tasks"][0]["task"] == "{nested}"
    assert not got[4][0] and got[4][1] is None
    assert not got[5][0]


def test_extraction_scoring_rules(spark):
    gold = spark.createDataFrame(
        [("d1", [("Ann", ["report"]), ("Bob", ["budget", "plan"])], ["Ann", "Bob"], [["launch", "friday"], ["hire"]], 2)],
        "dataset string, tasks array<struct<owner:string,task_keywords:array<string>>>, valid_owners array<string>, "
        "decision_keywords array<array<string>>, decisions_count int")
    outs = spark.createDataFrame([
        ("d1", "p", '{"tasks": [{"owner": " ann ", "task": "Write REPORT"}, {"owner": "Zed", "task": "x"}],'
                    ' "decisions": ["Launch on Friday"]}', 10, 5, 300),
        ("d1", "q", "garbage", 10, 1, 20),
    ], "dataset string, provider string, raw string, input_tokens long, output_tokens long, latency_ms long")
    r = {x["provider"]: x for x in E.extraction_eval(outs, gold).collect()}
    assert (r["p"]["tasks_found"], r["p"]["hallucinated_owners"], r["p"]["decisions_found"]) == (1, 1, 1)
    assert (r["q"]["tasks_found"], r["q"]["tasks_total"], r["q"]["decisions_total"]) == (0, 2, 2)


def test_stratified_split_keeps_proportions(spark):
    df = spark.range(1000).select(F.col("id").alias("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = E.stratified_split(df, "y", "id", seed=42)
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(1, "train")] == 70 and c[(1, "val")] == 15 and c[(1, "test")] == 15
    assert c[(0, "train")] == 630 and c[(0, "test")] == 135


def test_classification_report_zero_division(spark):
    pred = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    rows = {r["row"]: r for r in E.classification_report(pred).collect()}
    assert rows["0"]["precision"] == 0.0 and rows["0"]["recall"] == 0.0
    assert rows["1"]["precision"] == round(2 / 3, 4)
    assert rows["accuracy"]["f1"] == round(2 / 3, 4)


def test_reshape_keeps_ties_at_k(spark):
    model = spark.createDataFrame([("a", "x", 0.4), ("a", "y", 0.3), ("a", "z", 0.3)], "ch string, next string, p double")
    r = {(x["temperature"], x["top_k"]): x for x in LM.reshape(model, 3, [1.0], [None, 2, 1]).collect()}
    assert r[(1.0, 2)]["kept"] == 3  # tie at the 2nd value keeps both
    assert r[(1.0, 1)]["kept"] == 1 and r[(1.0, 1)]["entropy"] == 0.0
    assert math.isclose(r[(1.0, None)]["kept_mass"], 1.0)


def test_graph_cycle_case_and_depth(spark):
    edges = spark.createDataFrame([("A", "b"), ("b", "C"), ("C", "a"), ("b", "B2"), ("C", "d")], "source string, target string")
    roots = spark.createDataFrame([("A",)], "name string")
    nodes, _ = G.expand(edges, roots, max_depth=5)
    got = {r["key"]: r["level"] for r in nodes.collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "b2": 2, "d": 3}  # cycle back to 'a' ignored (case-insensitive)
    n0, _ = G.expand(edges, roots, max_depth=0)
    assert [r["key"] for r in n0.collect()] == ["a"]


def test_entropy(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "c string")
    r = E.distribution_entropy(df, "c").first()
    exp = -sum(p * math.log(p + 1e-9) for p in (0.5, 0.25, 0.25))
    assert abs(r["entropy"] - round(exp, 6)) < 1e-9 and r["categories"] == 3


def test_encode_decode_roundtrip(spark):
    docs = spark.createDataFrame([(1, "abca"), (2, "ba")], "doc_id long, text string")
    vocab = LM.vocabulary(docs)
    enc = LM.encode(docs, vocab)
    assert {r["doc_id"]: r["ids"] for r in enc.collect()} == {1: [0, 1, 2, 0], 2: [1, 0]}
    assert {r["doc_id"]: r["text"] for r in LM.decode(enc, vocab).collect()} == {1: "abca", 2: "ba"}
    blocks = LM.training_blocks(enc, block=2, stride=1).collect()
    assert all(len(b["x"]) == 2 and b["y"][0] == b["x"][1] for b in blocks)


def test_codec_runs_over_whole_texts_without_a_row_per_character(spark):
    rows = [(1, "é🙂ab"), (2, ""), (3, None), (4, "x" * 300 + "b"), (4, "a"), (None, "ß")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = LM.vocabulary(docs)
    assert "Generate" not in vocab._jdf.queryExecution().optimizedPlan().toString()
    order = sorted({c for _, t in rows for c in t or ""})
    assert {r["ch"]: r["id"] for r in vocab.collect()} == {c: i for i, c in enumerate(order)}
    known = vocab.filter("ch <> 'a'")
    left = [c for c in order if c != "a"]
    ids = LM.encode(docs, known)
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "instr" not in plan
    want = sorted(((d, None if t is None else [left.index(c) for c in t if c != "a"]) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in ids.collect()), key=str) == want
    back = sorted(((r["doc_id"], r["text"]) for r in LM.decode(ids, known).collect()), key=str)
    assert back == sorted(((d, t and t.replace("a", "")) for d, t in rows), key=str)
    odd = spark.createDataFrame([(1, [0, 99, None, 1])], "doc_id long, ids array<int>")
    assert LM.decode(odd, known).first()["text"] == "".join(left[:2])
    assert list(LM._row_groups([3, 3, 1, 9, 0], 4)) == [(0, 2), (2, 2), (4, 1)]


def test_corpus_pair_counts_equal_the_row_form(spark):
    docs = spark.createDataFrame([(1, "abcabca"), (2, "é🙂é🙂x"), (3, ""), (4, None), (5, "a"), (6, "ab" * 50)], "doc_id long, text string")
    rows = lambda d: sorted(map(tuple, d.select("split", "ch", "next", "cnt").collect()))
    assert rows(LM.corpus_pair_counts(docs)) == rows(LM.pair_counts(LM.pairs(docs.filter(F.length("text") > 0))))


def test_pair_counts_are_made_some_characters_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(LM, "PAIR_CHARS", 5)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["abcabca", "é🙂é🙂x", "", None, "a", "ab" * 50, "bc", "ca"])], "doc_id long, text string").coalesce(1)
    rows = lambda d: sorted(map(tuple, d.select("split", "ch", "next", "cnt").collect()))
    assert rows(LM.corpus_pair_counts(docs)) == rows(LM.pair_counts(LM.pairs(docs.filter(F.length("text") > 0))))


def test_kmeans_learns_from_stored_rows(spark):
    """The joins and groups behind the rows end before partitions are merged for the learners."""
    from ragloom.operators import ml as ML

    df = spark.range(90).select((F.col("id") % 30).alias("key"), (F.col("id") % 3 * 10.0).alias("v")).groupBy("key").agg(F.sum("v").alias("a"), F.count("v").alias("b"))
    assigned, profile = ML.kmeans_segments(df.withColumn("a", F.col("a") + F.col("key") / 100), ["a"], k=3, restarts=2)
    plan = assigned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(key" not in plan and "FileScan parquet" in plan
    assert sorted(r["size"] for r in profile.collect()) == [10, 10, 10]
