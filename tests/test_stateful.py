"""Keyed state and timers: streams equal their batch twins, and what happens
without a row happens by timers."""

import datetime as dt

import numpy as np

from ragloom.operators import llmops as L
from ragloom.operators import semantic_cache as C
from ragloom.sources.tables import request_log, table
from ragloom.streaming import jobs as S
from ragloom.streaming import stateful as T

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def parts(spark, rows, schema, n):
    size = -(-len(rows) // n)
    return S.Arrivals(spark, [spark.createDataFrame(rows[i:i + size], schema).repartition(2) for i in range(0, len(rows), size)])


def test_cache_stream_equals_the_replay_and_its_state_shrinks(spark):
    rng = np.random.default_rng(21)
    base = rng.normal(size=(4, 8))
    rows = [(i, at(i * 200), f"key-{i % 2}", [float(x) for x in base[rng.integers(4)] + rng.normal(scale=0.25, size=8)]) for i in range(120)]
    rows += [(500, at(120 * 200), None, None), (501, at(10**6), "key-9", [1.0] * 8)]  # no vector; long after everything
    schema = "request_id long, created_at timestamp, api_key string, embedding array<double>"
    came = parts(spark, rows, schema, 5)
    run = S.run_counted(T.stream_cache(came.stream(), "api_key"), "cache-test", arrivals=came, settle=True)
    got = {r["request_id"]: (r["hit"], r["matched_request_id"], r["similarity"], r["age_seconds"]) for r in spark.read.parquet(run.path).collect()}
    batch = C.cache_replay_sequential(spark.createDataFrame(rows, schema), block="api_key")
    want = {r["request_id"]: (r["hit"], r["matched_request_id"], r["similarity"], r["age_seconds"]) for r in batch.collect()}
    assert got == want
    assert 0 < sum(h for h, *_ in got.values()) < len(got)
    # one list of live entries a cache; those of the first two caches are gone at the end
    assert max(run.state_rows) > run.state_rows[-1] >= 1


def test_cache_query_shares_one_cache_between_keys(spark, tmp_path):
    """Requests of 12 API keys about 20 topics: answers come from entries of any
    key, and equal the batch replay's, where ids repeat too."""
    from ragloom.plans.registry import load_all

    rng = np.random.default_rng(4)
    events = [(i, at(20 * i), int(rng.integers(0, 50)), "view", 1.0, '{"k": 3}') for i in range(600)]
    events += [(7, at(140), 3, "view", 1.0, '{"k": 3}'), (601, None, 3, "view", 1.0, '{"k": 3}')]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    vectors = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(40)] + [(40, None, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = load_all()["semantic_cache_stream"].fn(spark, str(tmp_path)).collect()
    got = {r["request_id"]: tuple(r) for r in rows if r["request_id"] != 7}
    want = {r["request_id"]: tuple(r) for r in load_all()["semantic_cache_sequential"].fn(spark, str(tmp_path)).collect() if r["request_id"] != 7}
    assert got == want and len(rows) == len(got) + 2 and not got[601][1]
    again = sorted(tuple(r) for r in rows if r["request_id"] == 7)
    assert again[-1][1:] == (True, 7, 1.0, 0) if not again[0][1] else again[0] == again[1]
    key = {e[0]: e[2] % 12 for e in events}
    assert any(r[1] and key[r[0]] != key[r[2]] for r in got.values())


def test_shared_cache_keeps_live_entries_only(spark, tmp_path):
    rows = [(i, at(i * 60), [float(j == i) for j in range(240)]) for i in range(240)]
    came = parts(spark, rows, "request_id long, created_at timestamp, embedding array<double>", 4)
    S.run_to_table(came.stream(), "shared-test", foreach_batch=T.shared_cache(str(tmp_path)), arrivals=came)
    answers = spark.read.parquet(f"{tmp_path}/answers")
    assert answers.count() == 240 and answers.filter("hit").isEmpty()
    assert [spark.read.parquet(f"{tmp_path}/entries/batch={b}").count() for b in range(4)] == [60] * 4


def test_cache_state_holds_live_entries_only(spark):
    """Entries of one cache, all different: never more than a TTL of them."""
    processor = T.CacheProcessor(0.92, 3600 * 10**6, 6)

    class Handle:
        def __init__(self):
            self.state, self.timers = [], set()

        def getListState(self, name, schema):
            return self

        def exists(self):
            return bool(self.state)

        def get(self):
            return iter(self.state)

        def put(self, rows):
            self.state = list(rows)

        def clear(self):
            self.state = []

        def listTimers(self):
            return iter(self.timers)

        def registerTimer(self, t):
            self.timers.add(t)

        def deleteTimer(self, t):
            self.timers.discard(t)

    class Clock:
        ms = 0

        def getCurrentWatermarkInMs(self):
            return self.ms

    import pandas as pd

    handle, clock = Handle(), Clock()
    processor.init(handle)
    for b in range(6):
        us = np.arange(40) * 60 * 10**6 + b * 2400 * 10**6
        frame = pd.DataFrame({"us": us, "request_id": np.arange(40) + b * 40, "v": [np.eye(240)[b * 40 + i] for i in range(40)]})
        out = list(processor.handleInputRows(("k",), iter([frame[:15], frame[15:]]), clock))
        assert not out[0]["hit"].any() and len(handle.state) <= 60 and len(handle.timers) == 1
    clock.ms = 10**9
    list(processor.handleExpiredTimer(("k",), clock, None))
    assert handle.state == []


def test_breaker_stream_equals_the_replay_in_any_split(spark):
    calls = request_log(table(spark, SF, "events"))
    want = {tuple(r) for r in L.breaker_replay(calls, 5, 3600, 3600).select("request_id", "state_before", "skipped", "state_after", "recent_failures").collect()}
    rows = calls.select("request_id", "model", "created_at", "failed").orderBy("created_at", "request_id").collect()
    came = parts(spark, [tuple(r) for r in rows], "request_id long, model string, created_at timestamp, failed boolean", 5)
    out = spark.read.parquet(S.run_to_table(T.stream_breaker(came.stream(), 5, 3600, 3600), "breaker-test", arrivals=came))
    got = {tuple(r) for r in out.where("request_id is not null").select("request_id", "state_before", "skipped", "state_after", "recent_failures").collect()}
    assert got == want


def test_a_silent_model_reopens(spark):
    schema = "request_id long, model string, created_at timestamp, failed boolean"
    rows = [(i, "down", at(i), True) for i in range(5)] + [(10, "fine", at(4), False)]
    later = [(11, "fine", at(63), False)]  # "down" is not called again; its open time ends at 64 s
    last = [(12, "fine", at(70), False)]
    came = S.Arrivals(spark, [spark.createDataFrame(x, schema) for x in (rows, later, last)])
    out = spark.read.parquet(S.run_to_table(T.stream_breaker(came.stream()), "silent", arrivals=came, settle=True))
    timers = out.where("request_id is null").collect()
    assert [(r["model"], r["state_before"], r["state_after"], r["recent_failures"], r["at_us"]) for r in timers] == [
        ("down", "OPEN", "HALF_OPEN", 5, int((T0 - dt.datetime(1970, 1, 1)).total_seconds() + 64) * 10**6)]
    snapshot = {r["model"]: r["state"] for r in T.breaker_snapshot(out).collect()}
    assert snapshot == {"down": "HALF_OPEN", "fine": "CLOSED"}


def test_gauges_rise_and_fall_like_the_batch_at_every_tick(spark):
    log = request_log(table(spark, SF, "events"))
    rows = [tuple(r) for r in log.select("model", "created_at", "cache_hit", "failed", "aborted", "latency_ms").orderBy("created_at").collect()]
    rows.append(("model-quiet", rows[10][1], False, False, False, 1000))
    order = np.random.default_rng(1).permutation(len(rows) - 400).tolist()  # the first part in any order
    rows = [rows[i] for i in order] + rows[len(order):]
    came = parts(spark, rows, "model string, created_at timestamp, cache_hit boolean, failed boolean, aborted boolean, latency_ms long", 4)
    gauges = T.stream_service_gauges(came.stream(), tick_s=600, ttl_s=3600, unit_us=10**6, watermark="31 days")
    out = {(r["model"], r["tick_us"]): r for r in spark.read.parquet(S.run_to_table(gauges, "gauges-test", arrivals=came, settle=True)).collect()}
    assert out == {}  # the watermark has passed no tick
    came = parts(spark, sorted(rows, key=lambda r: r[1]), "model string, created_at timestamp, cache_hit boolean, failed boolean, aborted boolean, latency_ms long", 4)
    gauges = T.stream_service_gauges(came.stream(), tick_s=600, ttl_s=3600, unit_us=10**6)
    found = spark.read.parquet(S.run_to_table(gauges, "gauges-test", arrivals=came, settle=True)).collect()
    ticks = sorted({r["tick_us"] for r in found})
    full = spark.createDataFrame(rows, "model string, created_at timestamp, cache_hit boolean, failed boolean, aborted boolean, latency_ms long")
    for tick in (ticks[5], ticks[len(ticks) // 2], ticks[-1]):
        moment = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=tick)
        want = {r["model"]: tuple(r[c] for c in T.COUNTERS) for r in L.service_gauges(full, moment.isoformat(sep=" ")).collect()}
        last = {}
        for r in sorted(found, key=lambda r: r["tick_us"]):
            if r["tick_us"] <= tick:
                last[r["model"]] = tuple(r[c] for c in T.COUNTERS)
        assert last == want
    quiet = [r["active_streams"] for r in sorted(found, key=lambda r: r["tick_us"]) if r["model"] == "model-quiet"]
    assert quiet[0] == 1 and quiet[-1] == 0


def test_gauges_do_not_depend_on_the_order_of_arrival(spark):
    schema = "model string, created_at timestamp, cache_hit boolean, failed boolean, aborted boolean, latency_ms long"
    rows = [("m", at(s), s % 3 == 0, False, s % 5 == 0, 1000 * s) for s in range(0, 3000, 50)]
    mixed = [rows[i] for i in np.random.default_rng(2).permutation(len(rows))]
    end = [("other", at(10**5), True, False, False, 0)]
    tables = []
    for order in (rows, mixed):
        came = S.Arrivals(spark, [spark.createDataFrame(x, schema) for x in (order[:30], order[30:], end)])
        gauges = T.stream_service_gauges(came.stream(), watermark="2 hours")
        tables.append(sorted(tuple(r) for r in spark.read.parquet(S.run_to_table(gauges, "gauges-order", arrivals=came, settle=True)).collect()))
    assert tables[0] == tables[1] and len(tables[0]) > 50


def test_span_batches_by_count_or_timeout(spark):
    schema = "client string, trace_id int, span_id int, name string, start_ts timestamp"
    spans = [("a", 1, i, f"n{i}", at(i * 0.1)) for i in range(12)]  # ten are full, two are open
    spans += [("a", 2, 0, "late", at(3.2)), ("b", 3, 0, "x", at(0)), ("b", 3, 1, "y", at(1.9)), ("b", 3, 2, "z", at(2.0))]
    came = S.Arrivals(spark, [spark.createDataFrame(x, schema) for x in (spans, [("c", 9, 0, "end", at(60))])])
    out = spark.read.parquet(S.run_to_table(T.stream_span_flushes(came.stream(), "client"), "flushes", arrivals=came, settle=True))
    got = sorted((r["client"], r["batch_no"], r["spans"], r["names"], r["reason"]) for r in out.collect())
    assert got == [("a", 0, 10, ">".join(f"n{i}" for i in range(10)), "size"), ("a", 1, 2, "n10>n11", "timeout"), ("a", 2, 1, "late", "timeout"),
                   ("b", 0, 2, "x>y", "timeout"), ("b", 1, 1, "z", "timeout")]
