import os
import tempfile

from pyspark.sql import functions as F

from ragloom.operators import documents as D
from ragloom.sources.tables import request_log, table
from ragloom.streaming import jobs as S

SF = "/root/testdata/sf0.001"


def _stream(spark, name):
    schema = table(spark, SF, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(SF)


def test_token_windows_stream_equals_batch(spark):
    out = S.run_to_table(S.stream_token_windows(request_log(_stream(spark, "events")), "1 hour", "2 hours"), "t", mode="update")
    got = {(r["window_start"], r["api_key"]): r["tokens"] for r in S.latest_rows(spark, out, ["window_start", "api_key"]).collect()}
    b = request_log(table(spark, SF, "events")).groupBy(F.window("created_at", "1 hour").start.alias("ws"), "api_key").agg(
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("t"))
    exp = {(r["ws"], r["api_key"]): r["t"] for r in b.collect()}
    assert got == exp


def test_arrivals_come_whole_and_in_order_with_null_keys(spark):
    from ragloom.plans.streams import SLICES, arriving

    came = arriving(spark, SF, "events", "ts")
    run = S.run_counted(came.stream().select("event_id", "ts"), "arrivals-test", arrivals=came)
    assert run.rows == table(spark, SF, "events").count() == spark.read.parquet(run.path).count()
    nulls = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 9), (5, 1), (6, 7)], "event_id int, k int").repartition(3)
    nulls.write.parquet(os.path.join(tempfile.mkdtemp(prefix="ragloom-nulls-"), "t.parquet"))
    c = F.col("k")
    came = S.Arrivals(spark, [nulls.filter(c.isNull() | (c <= 4)), nulls.filter(c > 4)])
    run = S.run_counted(came.stream(), "null-keys", arrivals=came)
    assert sorted(r["event_id"] for r in spark.read.parquet(run.path).collect()) == [1, 2, 3, 4, 5, 6]
    assert SLICES == 4


def test_dropped_rows_are_counted(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    part = lambda rows: spark.createDataFrame([(i, t0 + dt.timedelta(hours=h)) for i, h in rows], "request_id long, created_at timestamp")
    came = S.Arrivals(spark, [part([(1, 10), (2, 11), (2, 11)]), part([(3, 12), (1, 10), (4, 1), (5, 2)]), part([(6, 13), (7, 3)])])
    run = S.run_counted(S.stream_dedupe(came.stream(), watermark="2 hours"), "dropped", arrivals=came, settle=True)
    kept = sorted(r["request_id"] for r in spark.read.parquet(run.path).collect())
    assert kept == [1, 2, 3, 6] and (run.rows, run.late, run.repeats) == (9, 3, 2)
    windows = S.Arrivals(spark, [part([(1, 10)]), part([(2, 12), (3, 1)])])
    tokens = windows.stream().selectExpr("*", "'k' as api_key", "1 as input_tokens", "1 as output_tokens")
    assert S.run_counted(S.stream_token_windows(tokens, "1 hour", "2 hours"), "late-windows", mode="update", arrivals=windows, settle=True).late == 1


def test_dedupe_stream_keeps_one_row_per_request(spark):
    a = request_log(_stream(spark, "events"))
    out = S.run_to_table(S.stream_dedupe(a.unionByName(request_log(_stream(spark, "events")))), "d")
    df = spark.read.parquet(out)
    assert df.count() == df.select("request_id").distinct().count() == table(spark, SF, "events").count()


def test_file_arrival_extracts_and_rewrites_keys(spark):
    root = tempfile.mkdtemp(prefix="ragloom-arrivals-")
    up = os.path.join(root, "uploads")
    os.makedirs(up)
    with open(os.path.join(up, "a.pdf"), "wb") as f:
        f.write(b"%PDF-1.4 tiny")
    with open(os.path.join(up, "b.pdf"), "wb") as f:
        f.write(b"<html><body><p>not a pdf</p></body></html>")
    with open(os.path.join(up, "c.txt"), "wb") as f:
        f.write(b"ignored by the glob")
    arrivals = S.file_arrivals(spark, up, "*.pdf")
    parsed = D.parse_files(arrivals).withColumn("target", S.processed_key())
    out = S.run_to_table(parsed.select("path", "target", "status", "error_type"), "arrivals")
    rows = {os.path.basename(r["path"]): r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"a.pdf", "b.pdf"}
    assert rows["b.pdf"]["error_type"] == "type_mismatch"
    assert rows["a.pdf"]["target"].endswith("/processed/a.txt")


def test_first_token_stream_and_span_batches(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="ragloom-tokens-")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(r, t0, t0 + dt.timedelta(milliseconds=r * 1000 + ms)) for r in (1, 2) for ms in (250, 400, 900)]
    spark.createDataFrame(rows, "request_id int, start_ts timestamp, ts timestamp").write.parquet(os.path.join(root, "tok"))
    src = spark.readStream.schema("request_id int, start_ts timestamp, ts timestamp").parquet(os.path.join(root, "tok"))
    out = S.run_to_table(S.stream_first_token(src), "ttft", mode="update")
    got = {r["request_id"]: r for r in S.latest_rows(spark, out, ["request_id"]).collect()}
    assert got[1]["ttft_ms"] == 1250.0 and got[1]["tokens"] == 3 and got[2]["total_ms"] == 2900.0
    spans = spark.createDataFrame([(1, t0, "embed"), (1, t0 + dt.timedelta(seconds=1), "generate"),
                                   (1, t0 + dt.timedelta(seconds=3), "store")], "trace_id int, start_ts timestamp, name string")
    spans.write.parquet(os.path.join(root, "spans"))
    s2 = spark.readStream.schema("trace_id int, start_ts timestamp, name string").parquet(os.path.join(root, "spans"))
    out2 = S.run_to_table(S.stream_span_batches(s2), "spans", mode="update")
    names = sorted(r["names"] for r in S.latest_rows(spark, out2, ["trace_id", "window_start"]).collect())
    assert names == ["embed>generate", "store"]


def test_small_parts_are_dealt_over_the_cores(spark):
    """a part that one task could write gives a micro-batch a file for every core."""
    part = spark.range(0, 1000, 1, 1).selectExpr("id AS event_id", "id % 7 AS k")
    came = S.Arrivals(spark, [part.filter("event_id < 500"), part.filter("event_id >= 500")])
    run = S.run_counted(came.stream(), "dealt", arrivals=came)
    for i in range(2):
        files = [f for f in os.listdir(f"{came.path}/part={i}") if f.endswith(".parquet")]
        assert len(files) >= spark.sparkContext.defaultParallelism
    assert sorted(r["event_id"] for r in spark.read.parquet(run.path).collect()) == list(range(1000))


def test_tables_of_streams_do_not_count_their_state(spark, monkeypatch):
    """keys are looked up once, and the session keeps its settings; a counted run still counts."""
    import datetime as dt

    t0, key = dt.datetime(2024, 1, 1), "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    seen, plain = [], S._counted
    monkeypatch.setattr(S, "_counted", lambda path, progress: seen.append(plain(path, progress)) or seen[-1])
    part = spark.createDataFrame([(1, t0, "a"), (1, t0 + dt.timedelta(seconds=3), "b"), (2, t0, "a")], "trace_id int, start_ts timestamp, name string")
    before = spark.conf.get(key, None)
    came = S.Arrivals(spark, [part])
    out = S.run_to_table(S.stream_span_batches(came.stream()), "uncounted", mode="update", arrivals=came)
    assert sorted(r["names"] for r in S.latest_rows(spark, out, ["trace_id", "window_start"]).collect()) == ["a", "a", "b"]
    came = S.Arrivals(spark, [part])
    S.run_counted(S.stream_span_batches(came.stream()), "counted", mode="update", arrivals=came)
    assert [r.state_rows for r in seen] == [[0], [3]] and spark.conf.get(key, None) == before


def test_guard_stream_tries_each_pattern_once(spark):
    """before, nine patterns were tried three times a text."""
    from ragloom.operators import llmops as L

    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id int, turn int, role string, text string")
    plan = S.stream_guard(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == len(L.INJECTION_PATTERNS)
