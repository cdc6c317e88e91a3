import json
import os
import tempfile

from pyspark.sql import functions as F

from ragloom.sources import files as SF


def _tmp():
    return tempfile.mkdtemp(prefix="ragloom-src-")


def test_corpus_qrels_pool_and_filters(spark):
    d = _tmp()
    with open(os.path.join(d, "corpus.jsonl"), "w") as f:
        for i in range(10):
            f.write(json.dumps({"_id": f"d{i}", "text": f"doc {i}"}) + "\n")
        f.write("{broken\n")
    with open(os.path.join(d, "qrels.tsv"), "w") as f:
        f.write("query-id\tcorpus-id\tscore\nq1\td7\t1\nq1\td2\t0\nq2\td9\t2\n")
    corpus = SF.read_corpus(spark, os.path.join(d, "corpus.jsonl"))
    assert len(corpus.filter(F.col("_corrupt_record").isNotNull()).select("_id", "text", "_corrupt_record").collect()) == 1
    good = corpus.filter(F.col("_id").isNotNull())
    q = SF.read_qrels(spark, os.path.join(d, "qrels.tsv"))
    assert sorted((r["qid"], r["did"]) for r in q.collect()) == [("q1", "d7"), ("q2", "d9")]
    assert SF.read_qrels(spark, os.path.join(d, "qrels.tsv"), positive_only=False).count() == 3
    pool = SF.candidate_pool(good, q, 3)
    assert sorted(r["_id"] for r in pool.collect()) == ["d0", "d1", "d2", "d7", "d9"]
    sub, q2 = SF.first_n_subset(good, q, 8)
    assert sub.count() == 8 and [r["qid"] for r in q2.collect()] == ["q1"]


def test_vector_contract(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [1.0]), (4, None)], "id int, embedding array<double>")
    ok, bad = SF.vector_contract(df, dim=2, id_col="id")
    assert [r["id"] for r in ok.collect()] == [1]
    assert {r["id"]: r["reason"] for r in bad.collect()} == {2: "not_normalised", 3: "wrong_dimension", 4: "null_vector"}


def test_parts_results_and_footprint(spark):
    d = _tmp()
    df = spark.range(120).select(F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    SF.write_parts(df, os.path.join(d, "parts"), part_rows=50)
    again = SF.write_parts(df, os.path.join(d, "parts"), part_rows=50)  # resumes: nothing pending
    assert again.count() == 120 and again.select("part_id").distinct().count() == 3
    res = spark.createDataFrame([("a", 1.0, None)], "db string, p50 double, note string")
    SF.write_results(res, os.path.join(d, "res"), ["db", "p50", "note", "missing"])
    back = SF.read_results(spark, [os.path.join(d, "res"), os.path.join(d, "nope")],
                           "db string, p50 double, note string, missing string").first()
    assert back["db"] == "a" and back["note"] is None
    fp = SF.footprint(spark, os.path.join(d, "parts")).first()
    assert fp["files"] >= 3 and fp["bytes"] > 0


def test_sectioned_log(spark):
    text = "\\n".join([
        "=== FAISS-HNSW(M=32,efC=200) ===", "index_time=283.0s disk=3200.0 MB",
        "ef=16: p50=0.21ms p95=0.3ms recall_qrels=0.954 recall_flat=0.988",
        "ef=32: p50=0.31ms p95=0.4ms recall_qrels=0.958 recall_flat=0.996",
        "=== pgvector ===", "ef=16: p50=6.58ms p95=11.3ms recall_qrels=0.9 recall_flat=0.95",
    ]).split("\\n")
    lines = spark.createDataFrame([("log", i, t) for i, t in enumerate(text)], "file string, line_no int, line string")
    rows = {r["db"]: r for r in SF.parse_sectioned_log(lines).collect()}
    assert set(rows) == {"FAISS-HNSW(efS=16)", "FAISS-HNSW(efS=32)", "pgvector(efS=16)"}
    # the index line is carried across sections, as in the source parser
    assert rows["FAISS-HNSW(efS=32)"]["index_time"] == 283.0 and rows["pgvector(efS=16)"]["index_time"] == 283.0


def test_caption_raw_and_gold_readers(spark):
    d = _tmp()
    with open(os.path.join(d, "a.vtt"), "w") as f:
        f.write("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nhello\n")
    with open(os.path.join(d, "b.vtt"), "w") as f:
        f.write("WEBVTT\n")
    with open(os.path.join(d, "gold.json"), "w") as f:
        json.dump({"dataset": "d1", "tasks": [{"owner": "Ann", "task_keywords": ["x"]}], "valid_owners": ["Ann"],
                   "decision_keywords": [["a", "b"]], "decisions_count": 1}, f, indent=2)
    lines = SF.read_caption_files(spark, d, ids=["a", "missing"]).collect()
    assert {r["file"] for r in lines} == {"a.vtt"} and any(r["line"] == "hello" for r in lines)
    raw = {r["name"]: r for r in SF.read_raw_files(spark, d, "*.vtt").collect()}
    assert raw["b.vtt"]["suffix"] == "vtt" and raw["b.vtt"]["size"] == 7
    g = SF.read_gold(spark, os.path.join(d, "gold.json")).first()
    assert g["dataset"] == "d1" and g["decision_keywords"] == [["a", "b"]]


def test_caption_folders_are_listed_by_few_tasks(spark):
    d = _tmp()
    for i in range(60):
        os.makedirs(os.path.join(d, f"file={i}"))
        with open(os.path.join(d, f"file={i}", "part.txt"), "w") as f:
            f.write(f"line {i}")
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.parallelPartitionDiscovery.parallelism",)}
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        lines = SF.read_caption_files(spark, d, suffix=".txt", name=r"file=([^/]+)/")
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * sc.defaultParallelism
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert {k: spark.conf.get(k) for k in before} == before
    assert sorted((r["file"], r["line"]) for r in lines.collect()) == sorted((str(i), f"line {i}") for i in range(60))


def test_corpus_parts_follow_the_session(spark):
    """The corpus and the qrels are put in order by as many tasks as the session shuffles with."""
    from ragloom.plans.files import retrieval_tables

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        for df in retrieval_tables(spark, "/root/testdata/sf0.001")[::2]:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "rangepartitioning(doc_id" in plan and ", 9)" in plan, plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
