"""Registered streaming queries: each runs a Structured Streaming job over a
test table read as a file stream (``availableNow``), then returns the sink's
content; the oracle is the SQL of the batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import REQUEST_LOG_SQL, request_log, table
from ..streaming import jobs as S
from ..streaming import stateful as T
from .llmops import BREAKER_OPEN_S, BREAKER_WINDOW_S, SQL_BREAKER, SQL_CACHE_SEQUENTIAL, _guard_sql, guard_input, with_vectors
from .registry import register


SLICES = 4


def arriving(spark: SparkSession, sf: str, name: str, order: str) -> S.Arrivals:
    """A test table that arrives in ``SLICES`` parts in ``order``; rows without
    a value there come first."""
    df = table(spark, sf, name)
    cuts = df.select(F.percentile_approx(order, [i / SLICES for i in range(1, SLICES)])).first()[0] or []
    c = F.col(order)
    bounds = [None, *cuts, None]
    parts = []
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (c > F.lit(lo))
        if hi is not None:
            inside = inside & (c <= F.lit(hi))
        parts.append(df.filter(inside | c.isNull() if lo is None else inside))
    return S.Arrivals(spark, parts)


@register("token_window_stream", sql=f"""
WITH req AS ({REQUEST_LOG_SQL})
SELECT strftime(time_bucket(INTERVAL 1 HOUR, created_at), '%Y-%m-%d %H:%M:%S') AS window_start, api_key,
       CAST(sum(input_tokens + output_tokens) AS BIGINT) AS tokens, count(*) AS requests
FROM req GROUP BY ALL""", ops="STR1 FUN12")
def token_window_stream(spark: SparkSession, sf: str) -> DataFrame:
    came = arriving(spark, sf, "events", "ts")
    log = request_log(came.stream())
    out = S.run_to_table(S.stream_token_windows(log, "1 hour", "2 hours"), "token_windows", mode="update", arrivals=came)
    r = S.latest_rows(spark, out, ["window_start", "api_key"])
    return r.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@register("rolling_usage_stream", sql=f"""
WITH req AS ({REQUEST_LOG_SQL}),
w AS (SELECT time_bucket(INTERVAL 1 HOUR, created_at) - INTERVAL (r.hk) HOUR AS window_start, api_key,
             input_tokens + output_tokens AS t
      FROM req, range(24) r(hk))
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, api_key, count(*) AS requests,
       CAST(sum(t) AS BIGINT) AS tokens FROM w GROUP BY ALL""",
          ops="STR2")
def rolling_usage_stream(spark: SparkSession, sf: str) -> DataFrame:
    came = arriving(spark, sf, "events", "ts")
    log = request_log(came.stream())
    out = S.run_to_table(S.stream_rolling_usage(log), "rolling_usage", mode="update", arrivals=came)
    r = S.latest_rows(spark, out, ["window_start", "api_key"])
    return r.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@register("dedupe_stream", sql=f"""
WITH req AS ({REQUEST_LOG_SQL})
SELECT request_id, api_key, CAST(input_tokens + output_tokens AS BIGINT) AS tokens FROM req""", ops="STR3")
def dedupe_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Each event is delivered twice (the same arriving files are read by two
    sources, as an at-least-once source would give them); the stream keeps one
    row per request."""
    came = arriving(spark, sf, "events", "ts")
    twice = request_log(came.stream()).unionByName(request_log(came.stream()))
    out = S.run_to_table(S.stream_dedupe(twice), "dedupe", arrivals=came)
    return spark.read.parquet(out).select("request_id", "api_key",
                                          (F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("tokens"))


@register("guard_stream", sql=f"""WITH {_guard_sql()}
SELECT role, reject_reason, pattern, leak_marker, count(*) AS n FROM guarded
WHERE reject_reason IS NOT NULL OR leak_marker IS NOT NULL GROUP BY ALL""", ops="STR6 SNK7")
def guard_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = uuid.uuid4().hex[:12]
    rejected, clean = scratch_path(spark, f"guard/{run}/rejected"), scratch_path(spark, f"guard/{run}/clean")
    came = arriving(spark, sf, "conversations", "conv_id")
    S.run_to_table(S.stream_guard(guard_input(came.stream())), "guard", foreach_batch=S.guard_sinks(rejected, clean), arrivals=came)
    bad = spark.read.schema("role string, reject_reason string, pattern string, leak_marker string").json(rejected)
    return bad.groupBy("role", "reject_reason", "pattern", "leak_marker").agg(F.count(F.lit(1)).alias("n"))


@register("service_gauges_stream", sql=f"""
WITH req AS ({REQUEST_LOG_SQL})
SELECT model, count(*) AS total, CAST(sum(CAST(cache_hit AS INTEGER)) AS BIGINT) AS hits,
       CAST(sum(CAST(NOT cache_hit AS INTEGER)) AS BIGINT) AS misses, CAST(sum(CAST(failed AS INTEGER)) AS BIGINT) AS failures,
       CAST(sum(CAST(aborted AS INTEGER)) AS BIGINT) AS aborted
FROM req GROUP BY model""", ops="STR8 AGG25")
def service_gauges_stream(spark: SparkSession, sf: str) -> DataFrame:
    came = arriving(spark, sf, "events", "ts")
    log = request_log(came.stream())
    out = S.run_to_table(S.stream_gauges(log), "gauges", mode="update", arrivals=came)
    g = S.latest_rows(spark, out, ["model"])
    return g.select("model", "total", *[F.col(c).cast("bigint").alias(c) for c in ("hits", "misses", "failures", "aborted")])


def _breaker_rows(spark: SparkSession, sf: str, settle: bool) -> DataFrame:
    came = arriving(spark, sf, "events", "ts")
    calls = T.stream_breaker(request_log(came.stream()), 5, BREAKER_WINDOW_S, BREAKER_OPEN_S)
    return spark.read.parquet(S.run_to_table(calls, "breaker", arrivals=came, settle=settle))


@register("breaker_stream", sql=SQL_BREAKER, ops="STR4 LLM4")
def breaker_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The calls of the breaker stream; same answers as the replay."""
    return _breaker_rows(spark, sf, settle=False).filter(F.col("request_id").isNotNull()).drop("at_us")


@register("breaker_snapshot_stream", sql=SQL_BREAKER.replace(
    "SELECT request_id, model, state_before, skipped, state_after, CAST(len(fails) AS INTEGER) AS recent_failures\nFROM walk", """,
seen AS (SELECT max(epoch_ms(created_at)) AS watermark FROM req),
last AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY model ORDER BY rn DESC) = 1)
SELECT model, CASE WHEN state_after = 'OPEN' AND open_until * 1000 <= watermark THEN 'HALF_OPEN' ELSE state_after END AS state,
       CAST(len(fails) AS INTEGER) AS recent_failures
FROM last, seen"""), ops="STR4 AGG25")
def breaker_snapshot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Each model's state when the last row has come: a model whose calls have
    ended reopens by its timer."""
    return T.breaker_snapshot(_breaker_rows(spark, sf, settle=True))


@register("semantic_cache_stream", sql=SQL_CACHE_SEQUENTIAL, ops="STR5 LLM2 FIL11")
def semantic_cache_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The semantic cache that all API keys share over the request stream, with
    the live entries as state; same answers as the sequential replay."""
    came = arriving(spark, sf, "events", "ts")
    asked = with_vectors(request_log(came.stream()), table(spark, sf, "embeddings"))
    path = scratch_path(spark, f"cache/{uuid.uuid4().hex}")
    S.run_to_table(asked, "cache", foreach_batch=T.shared_cache(path), arrivals=came)
    return spark.read.parquet(f"{path}/answers").drop("row", "batch")


@register("gauge_ticks_stream", sql=f"""
WITH req AS ({REQUEST_LOG_SQL}),
r AS (SELECT model, epoch_us(created_at) AS us, cache_hit, aborted, NOT cache_hit AND NOT failed AND NOT aborted AS stores, latency_ms * 1000000 AS lasts FROM req),
changes AS (
  SELECT model, us, 1 AS total, CAST(cache_hit AS INTEGER) AS hits, CAST(NOT cache_hit AS INTEGER) AS misses, CAST(aborted AS INTEGER) AS aborted,
         CAST(lasts > 0 AS INTEGER) AS active_streams, CAST(stores AS INTEGER) AS live_entries FROM r
  UNION ALL SELECT model, us + lasts, 0, 0, 0, 0, -1, 0 FROM r WHERE lasts > 0
  UNION ALL SELECT model, us + 3600000000, 0, 0, 0, 0, 0, -1 FROM r WHERE stores),
ticks AS (SELECT model, (us + 599999999) // 600000000 * 600000000 AS tick_us, sum(total) AS total, sum(hits) AS hits, sum(misses) AS misses, sum(aborted) AS aborted,
                 sum(active_streams) AS active_streams, sum(live_entries) AS live_entries FROM changes GROUP BY ALL)
SELECT model, tick_us, {", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}" for c in T.COUNTERS)}
FROM ticks WINDOW w AS (PARTITION BY model ORDER BY tick_us)
QUALIFY tick_us <= (SELECT max(epoch_ms(created_at)) * 1000 FROM req)""", ops="STR8 AGG25")
def gauge_ticks_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Service gauges every ten minutes, with running streams (latency taken as
    seconds) and live cache entries that fall again."""
    came = arriving(spark, sf, "events", "ts")
    gauges = T.stream_service_gauges(request_log(came.stream()), tick_s=600, ttl_s=3600, unit_us=1_000_000)
    return spark.read.parquet(S.run_to_table(gauges, "gauge-ticks", arrivals=came, settle=True))


SPAN_STEPS = ["embed", "cache", "retrieve", "generate", "store"]
SPAN_TIMEOUT_S = 3600  # the stand-in log is sparse; the source waits two seconds


@register("span_flush_stream", sql=f"""
WITH RECURSIVE req AS ({REQUEST_LOG_SQL}),
spans AS (
  SELECT api_key AS client, epoch_us(created_at) AS us, n.name,
         row_number() OVER (PARTITION BY api_key ORDER BY created_at, request_id, n.i) AS rn
  FROM req, (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(SPAN_STEPS))}) n(i, name)),
walk AS (
  SELECT client, rn, us, name, us AS first_us, 1 AS k, 0 AS batch_no FROM spans WHERE rn = 1
  UNION ALL
  SELECT s.client, s.rn, s.us, s.name, CASE WHEN fresh THEN s.us ELSE first_us END, CASE WHEN fresh THEN 1 ELSE k + 1 END, batch_no + CAST(fresh AS INTEGER)
  FROM (SELECT w.client, w.rn, w.first_us, w.k, w.batch_no FROM walk w) w JOIN spans s ON s.client = w.client AND s.rn = w.rn + 1,
       (SELECT w.k = 10 OR s.us >= w.first_us + {SPAN_TIMEOUT_S * 1_000_000} AS fresh))
SELECT client, CAST(batch_no AS BIGINT) AS batch_no, first_us, count(*) AS spans, string_agg(name, '>' ORDER BY rn) AS names,
       CASE WHEN count(*) = 10 THEN 'size' ELSE 'timeout' END AS reason
FROM walk GROUP BY client, batch_no, first_us
HAVING count(*) = 10 OR first_us + {SPAN_TIMEOUT_S * 1_000_000} <= (SELECT max(epoch_ms(created_at)) * 1000 FROM req)""", ops="STR10")
def span_flush_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Five spans a request, batched per API key: flushed at ten spans or an
    hour after the first."""
    came = arriving(spark, sf, "events", "ts")
    names = F.array(*[F.lit(n) for n in SPAN_STEPS])
    spans = request_log(came.stream()).select("api_key", F.col("request_id").alias("trace_id"), F.col("created_at").alias("start_ts"),
                                              F.posexplode(names).alias("span_id", "name"))
    out = S.run_to_table(T.stream_span_flushes(spans, "api_key", timeout_s=SPAN_TIMEOUT_S), "span-flushes", arrivals=came, settle=True)
    return spark.read.parquet(out)
