"""Registered queries for operators that the other plan modules leave out:
search variants and contracts, timing reports, admission, tokens, chunks,
tables and graphs, and the short streaming jobs.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import documents as D
from ..operators import embed as EM
from ..operators import evals as E
from ..operators import graph as G
from ..operators import llmops as L
from ..operators import lm as LM
from ..operators import metrics as M
from ..operators import retrieval as R
from ..operators.common import stored
from ..session import scratch_path
from ..sources.tables import REQUEST_LOG_SQL, embeddings, request_log, table, tiers
from ..streaming import jobs as S
from .documents import CHUNK_OVERLAP, CHUNK_SIZE
from .evals import MAX_DEPTH, part_edges
from .llmops import SQL_LOG, guard_input, log, requests
from .llmops import _guard_sql as guard_sql
from .registry import register
from .retrieval import (
    SQL_BM25,
    SQL_DENSE_SCORES,
    SQL_IVF,
    _hashed_sql,
    dense_corpus,
    dense_queries,
    ivf_centroids,
    lexical_inputs,
)
from .streams import arriving

# ---------------------------------------------------------------------------
# Search variants and contracts
# ---------------------------------------------------------------------------

_NOISY_Q = SQL_DENSE_SCORES.split("s AS (")[0].rstrip().rstrip(",")
_DOT = "list_dot_product(q.v, d.v)"
_COS = f"{_DOT} / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v)))"


def _topk_sql(score: str, k: int, where: str = "true") -> str:
    return f"""SELECT q.qid, d.did, round({score}, 6) AS score,
  CAST(row_number() OVER (PARTITION BY q.qid ORDER BY round({score}, 6) DESC, d.did) AS INTEGER) AS rank
FROM q, d WHERE {where} QUALIFY rank <= {k}"""


@register("filtered_dense_topk", sql=f"WITH {_NOISY_Q} {_topk_sql(_COS, 5, 'd.did IN (SELECT vec_id FROM embeddings WHERE label % 2 = 0)')}", ops="RET2")
def filtered_dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 among the vectors of even labels; the filter reaches the scan."""
    corpus = embeddings(spark, sf).withColumnRenamed("vec_id", "did")
    return R.filtered_topk(dense_queries(spark, sf), corpus, 5, F.col("label") % 2 == 0)


_L2 = "-sqrt(list_sum(list_transform(list_zip(q.v, d.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"


@register("metric_choice", sql=f"""WITH {_NOISY_Q}
SELECT 'l2' AS metric, * FROM ({_topk_sql(_L2, 5)}) UNION ALL SELECT 'ip', * FROM ({_topk_sql(_DOT, 5)})""", ops="RET15 RET1")
def metric_choice(spark: SparkSession, sf: str) -> DataFrame:
    q, d = dense_queries(spark, sf), dense_corpus(spark, sf)
    one = lambda m: R.exact_topk(q, d, 5, metric=m).select(F.lit(m).alias("metric"), "qid", "did", "score", "rank")
    return one("l2").unionByName(one("ip"))


@register("vector_functions", sql="""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a, list_reverse(CAST(embedding AS DOUBLE[])) AS b FROM embeddings)
SELECT vec_id, round(list_dot_product(a, b), 6) AS ip, round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS cosine,
       round(1 - list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS cosine_distance,
       round(sqrt(list_sum(list_transform(list_zip(a, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 6) AS l2,
       round(sqrt(list_dot_product(a, a)), 6) AS norm, round(a[1] / sqrt(list_dot_product(a, a)), 6) AS first_unit FROM e""", ops="FUN11")
def vector_functions(spark: SparkSession, sf: str) -> DataFrame:
    """All native vector functions, of each vector and its reverse."""
    e = embeddings(spark, sf).select("vec_id", F.col("embedding").alias("a"), F.reverse("embedding").alias("b"))
    r = lambda c: F.round(c, 6)
    return e.select("vec_id", r(V.similarity("ip", "a", "b")).alias("ip"), r(V.similarity("cosine", "a", "b")).alias("cosine"),
                    r(V.cosine_distance("a", "b")).alias("cosine_distance"), r(-V.similarity("l2", "a", "b")).alias("l2"),
                    r(V.l2_norm("a")).alias("norm"), r(F.element_at(V.normalize("a"), 1)).alias("first_unit"))


@register("nearest_one", sql="""
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings ORDER BY vec_id LIMIT 1),
d AS (SELECT vec_id AS did, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT did, round(1 - list_dot_product(q.v, d.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v))), 6) + 0.0 AS distance
FROM q, d ORDER BY distance, did LIMIT 10""", ops="SRT3")
def nearest_one(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 nearest vectors to one, ordered by distance."""
    one = embeddings(spark, sf).orderBy("vec_id").first()["embedding"]
    return R.nearest(dense_corpus(spark, sf), one, 10).select("did", (F.round("distance", 6) + 0.0).alias("distance"))


@register("sanity_cosine", sql=f"WITH {_NOISY_Q} SELECT q.qid, d.did, round({_COS}, 6) AS cosine FROM q JOIN d ON d.did = q.qid", ops="RET10")
def sanity_cosine(spark: SparkSession, sf: str) -> DataFrame:
    q = dense_queries(spark, sf)
    return R.sanity_cosine(q, dense_corpus(spark, sf), q.select("qid", F.col("qid").alias("did")))


@register("retriever_contract", sql=f"""WITH {SQL_DENSE_SCORES}, {SQL_BM25}
SELECT 'dense' AS retriever, qid, did, rank FROM ranked WHERE rank <= 5
UNION ALL SELECT 'bm25', qid, did, rank FROM bm25_ranked WHERE rank <= 5""", ops="UDF1")
def retriever_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Two retrievers behind one interface."""
    docs, items = lexical_inputs(spark, sf)
    found = [(n, r.search(q, 5)) for n, r, q in (("dense", R.DenseRetriever(dense_corpus(spark, sf)), dense_queries(spark, sf)),
                                                 ("bm25", R.BM25Retriever(docs), items))]
    parts = [d.select(F.lit(n).alias("retriever"), "qid", "did", "rank") for n, d in found]
    return parts[0].unionByName(parts[1])


@register("index_contract", sql=f"""WITH {SQL_IVF}
SELECT qid, did, CAST(rank AS INTEGER) AS rank, (SELECT count(*) FROM embeddings) AS vectors FROM approx WHERE nprobe = 4""", ops="UDF2 SNK9 RET6")
def index_contract(spark: SparkSession, sf: str) -> DataFrame:
    """An index built to a path, searched with a probe setting, and measured."""
    index = R.IVFIndex(ivf_centroids(spark, sf))
    index.build(dense_corpus(spark, sf), scratch_path(spark, f"ivf-{uuid.uuid4().hex}"))
    size = index.footprint().select("vectors")
    return index.search(dense_queries(spark, sf), 10, (4,)).select("qid", "did", "rank").join(size, F.lit(True))  # one row


QUERY_PREFIX = "query: "


def hashing_model():
    """A text -> vector model for the embedder: token counts by md5 bucket."""
    def run(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), EM.HASH_DIM))
        for i, t in enumerate(texts):
            for tok in re.findall(r"[a-z0-9]+", t.lower()):
                out[i, int(hashlib.md5(tok.encode()).hexdigest()[:2], 16)] += 1
        return out

    return run


@register("prefixed_embedding", sql=f"""WITH src AS (SELECT item_id, '{QUERY_PREFIX}' || text AS text FROM benchmark), {_hashed_sql('src', 'item_id', 'h')}
SELECT id AS item_id, CAST({EM.HASH_DIM} AS INTEGER) AS dim, CAST(count(*) AS INTEGER) AS filled, round(max(w), 4) AS largest FROM h GROUP BY id""", ops="UDF4 FUN18")
def prefixed_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item embedded in batches with the query prefix."""
    v = EM.embed(table(spark, sf, "benchmark"), "text", hashing_model, id_col="item_id", prefix=QUERY_PREFIX)
    e = F.col("embedding")
    return v.select("item_id", F.size(e).alias("dim"), F.size(F.filter(e, lambda x: x > 0)).alias("filled"),
                    F.round(F.array_max(e).cast("double"), 4).alias("largest"))


# ---------------------------------------------------------------------------
# Timing and result reports
# ---------------------------------------------------------------------------


def _two_level_sql(how: str, red: str) -> str:
    q = lambda p: f"round(quantile_cont(v, {p}), 4)"
    return f"""SELECT '{how}' AS repeats, model, count(*) AS n, {q(0.5)} AS p50, {q(0.95)} AS p95, {q(0.99)} AS p99, round(avg(v), 4) AS mean,
  round(min(v), 4) AS min, round(max(v), 4) AS max
FROM (SELECT model, api_key, CAST({red} AS DOUBLE) AS v FROM lg GROUP BY model, api_key) GROUP BY model"""


@register("latency_two_level", sql=f"WITH {SQL_LOG} {_two_level_sql('median', 'median(latency_ms)')} UNION ALL {_two_level_sql('min', 'min(latency_ms)')}", ops="AGG6 AGG5")
def latency_two_level(spark: SparkSession, sf: str) -> DataFrame:
    """Latency per model over keys, each key's repeats first reduced by their
    median or minimum."""
    one = lambda how: M.latency_summary(log(spark, sf), by=["model"], per="api_key", repeat=how).withColumn("repeats", F.lit(how))
    return one("median").unionByName(one("min"))


@register("throughput", sql=f"""WITH {SQL_LOG}
SELECT model, count(*) AS n, round(count(*) / sum(latency_ms) * 1000.0, 3) AS qps FROM lg GROUP BY model""", ops="AGG7")
def throughput(spark: SparkSession, sf: str) -> DataFrame:
    return M.throughput(log(spark, sf), by=["model"])


SQL_TOKENS = f"""
req AS ({REQUEST_LOG_SQL}),
tok AS (SELECT request_id, epoch_us(created_at) AS st, epoch_us(created_at) + ttft_ms * 1000 + i * (37 + request_id % 5 * 11) * 1000 AS us, i
        FROM req, range(7) r(i) WHERE i < 1 + request_id % 6)
"""


def answer_tokens(df: DataFrame) -> DataFrame:
    """Stand-in token stream of an answer: 1 to 6 tokens after its time to
    first token, at a pace that depends on the request."""
    t = df.select("request_id", F.col("created_at").alias("start_ts"), "ttft_ms",
                  F.explode(F.sequence(F.lit(0), (F.col("request_id") % 6).cast("int"))).alias("i"))
    us = F.unix_micros("start_ts") + F.col("ttft_ms") * 1000 + F.col("i") * (37 + F.col("request_id") % 5 * 11) * 1000
    return t.select("request_id", "start_ts", F.timestamp_micros(us).alias("ts"))


@register("stream_timing", sql=f"""WITH {SQL_TOKENS},
g AS (SELECT *, (us - lag(us) OVER (PARTITION BY request_id ORDER BY us)) / 1000.0 AS gap FROM tok)
SELECT request_id, (min(us) - min(st)) / 1000.0 AS ttft_ms, round(avg(gap), 3) AS mean_gap_ms, round(max(gap), 3) AS max_gap_ms, count(*) AS tokens,
       round(CASE WHEN max(us) > min(st) THEN count(*) / ((max(us) - min(st)) / 1000.0 / 1000.0) END, 3) AS tokens_per_s, (max(us) - min(st)) / 1000.0 AS total_ms
FROM g GROUP BY request_id""", ops="AGG29 WIN9")
def stream_timing(spark: SparkSession, sf: str) -> DataFrame:
    return M.stream_timing(answer_tokens(requests(spark, sf)))


@register("first_token_stream", sql=f"""WITH {SQL_TOKENS}
SELECT request_id, (min(us) - min(st)) / 1000.0 AS ttft_ms, count(*) AS tokens, (max(us) - min(st)) / 1000.0 AS total_ms,
       round(CASE WHEN max(us) > min(st) THEN count(*) / ((max(us) - min(st)) / 1000.0 / 1000.0) END, 3) AS tokens_per_s
FROM tok GROUP BY request_id""", ops="STR9 AGG29")
def first_token_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Time to first token as the token stream arrives."""
    came = arriving(spark, sf, "events", "ts")
    out = S.run_to_table(S.stream_first_token(answer_tokens(request_log(came.stream()))), "first-token", mode="update", arrivals=came)
    return S.latest_rows(spark, out, ["request_id"])


SPAN_NAMES = ["embed", "cache", "generate"]


@register("span_batch_stream", sql=f"""WITH req AS ({REQUEST_LOG_SQL}),
sp AS (SELECT request_id AS trace_id, epoch_us(created_at) + i * 1500000 AS us, {SPAN_NAMES}[CAST(i + 1 AS INTEGER)] AS name FROM req, range(3) r(i))
SELECT trace_id, us // 2000000 * 2000 AS window_ms, count(*) AS spans, string_agg(name, '>' ORDER BY us) AS names FROM sp GROUP BY ALL""", ops="STR10")
def span_batch_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of each trace in two-second batches."""
    came = arriving(spark, sf, "events", "ts")
    r = request_log(came.stream())
    names = F.array(*[F.lit(n) for n in SPAN_NAMES])
    spans = r.select(F.col("request_id").alias("trace_id"), "created_at", F.posexplode(names).alias("i", "name")).select(
        "trace_id", "name", F.timestamp_micros(F.unix_micros("created_at") + F.col("i") * 1_500_000).alias("start_ts"))
    out = S.run_to_table(S.stream_span_batches(spans), "span-batches", mode="update", arrivals=came)
    return S.latest_rows(spark, out, ["trace_id", "window_start"]).select(
        "trace_id", F.unix_millis("window_start").alias("window_ms"), "spans", "names")


@register("daily_usage_stream", sql=f"""WITH req AS ({REQUEST_LOG_SQL})
SELECT strftime(created_at, '%Y-%m-%d') AS day, api_key, count(*) AS requests, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS tokens FROM req GROUP BY ALL""", ops="STR2")
def daily_usage_stream(spark: SparkSession, sf: str) -> DataFrame:
    came = arriving(spark, sf, "events", "ts")
    out = S.run_to_table(S.stream_rolling_usage(request_log(came.stream()), "1 day", "1 day"), "daily", mode="update", arrivals=came)
    r = S.latest_rows(spark, out, ["window_start", "api_key"])
    return r.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "api_key", "requests", "tokens")


@register("late_rows_stream", sql=f"""WITH req AS ({REQUEST_LOG_SQL}), m AS (SELECT max(created_at) AS hi FROM req)
SELECT 'kept' AS outcome, model, count(*) AS n FROM req, m WHERE created_at > hi - INTERVAL 1 DAY GROUP BY model
UNION ALL SELECT 'late', NULL, count(*) FROM req, m WHERE created_at <= hi - INTERVAL 1 DAY
UNION ALL SELECT 'repeated', NULL, count(*) FROM req, m WHERE created_at > hi - INTERVAL 1 DAY
UNION ALL SELECT 'read', NULL, count(*) + count(*) FILTER (created_at > hi - INTERVAL 1 DAY) FROM req, m""", ops="STR3")
def late_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The newest day, the same once more, then everything older: the repeats
    count once, and what is older than the watermark of the batch before is late
    and dropped. Rows that were kept, and how many were late or repeated, so
    that nothing goes missing unseen."""
    ev = table(spark, sf, "events")
    newest = ev.filter(F.col("ts").cast("timestamp") > ev.select(F.max(F.col("ts").cast("timestamp")) - F.expr("INTERVAL 1 DAY")).scalar())
    old = ev.join(newest.select("event_id"), "event_id", "left_anti").select(ev.columns)
    came = S.Arrivals(spark, [newest, newest, old])
    run = S.run_counted(S.stream_dedupe(request_log(came.stream()), watermark="1 day"), "late", arrivals=came, settle=True)
    kept = spark.read.parquet(run.path).groupBy("model").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("outcome"), "model", "n")
    counts = [("late", None, run.late), ("repeated", None, run.repeats), ("read", None, run.rows)]
    return kept.unionByName(spark.createDataFrame(counts, "outcome string, model string, n bigint"))


_VARIANTS = """
base AS (SELECT user_id % 4 AS size, event_type AS retriever, user_id % 3 AS pos, round(avg(value), 4) AS score, count(*) AS n FROM events
         WHERE event_type = 'click' GROUP BY ALL),
vars AS (SELECT user_id % 4 AS size, event_type AS retriever, user_id % 3 AS pos, round(max(value), 4) AS score FROM events GROUP BY ALL)
"""


@register("compare_to_baseline", sql=f"""WITH {_VARIANTS},
u AS (SELECT 0 AS l, size, retriever, pos, score FROM base UNION ALL SELECT 1, size, retriever, pos, score FROM vars),
f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY size, retriever ORDER BY l, pos) = 1),
b AS (SELECT size, arg_min(score, pos) AS base_score FROM base GROUP BY size)
SELECT f.size, f.retriever, f.pos, f.score, b.base_score, round(f.score - b.base_score, 4) AS delta_score FROM f LEFT JOIN b USING (size)""", ops="JON14")
def compare_to_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Each size's results beside the baseline's, first row of a name kept."""
    ev = table(spark, sf, "events").select((F.col("user_id") % 4).alias("size"), F.col("event_type").alias("retriever"), (F.col("user_id") % 3).alias("pos"), "value")
    keys = ["size", "retriever", "pos"]
    base = ev.filter(F.col("retriever") == "click").groupBy(*keys).agg(F.round(F.avg("value"), 4).alias("score"))
    variants = ev.groupBy(*keys).agg(F.round(F.max("value"), 4).alias("score"))
    return M.compare_to_baseline(base, variants, "size", "retriever", ["score"], ["pos"])


@register("loss_curves", sql=f"""WITH req AS ({REQUEST_LOG_SQL}),
c AS (SELECT model AS run, CAST(day(created_at) AS INTEGER) AS step, avg(ttft_ms) AS train_loss, avg(latency_ms) AS val_loss FROM req GROUP BY ALL)
SELECT run, arg_min(step, val_loss) AS best_step, round(min(val_loss), 4) AS best_val, round(arg_max(train_loss, step), 4) AS final_train,
       round(arg_max(val_loss, step), 4) AS final_val, round(round(arg_max(val_loss, step), 4) - round(arg_max(train_loss, step), 4), 4) AS gap
FROM c GROUP BY run""", ops="ML17")
def loss_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in curves: mean first-token and total latency per model and day."""
    r = request_log(table(spark, sf, "events"))
    curve = r.groupBy(F.col("model").alias("run"), F.dayofmonth("created_at").alias("step")).agg(
        F.avg("ttft_ms").alias("train_loss"), F.avg("latency_ms").alias("val_loss"))
    return E.loss_curve_summary(curve)


@register("feature_ratios", sql="""
SELECT o_orderkey, round(CASE WHEN c_acctbal * 12 <> 0 THEN o_totalprice / (c_acctbal * 12) END, 3) AS ratio
FROM orders JOIN customer ON c_custkey = o_custkey""", ops="FUN19")
def feature_ratios(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return j.select("o_orderkey", E.feature_ratio(F.col("o_totalprice"), F.col("c_acctbal"), F.lit(12)).alias("ratio"))


# ---------------------------------------------------------------------------
# Admission, guard chain, gauges, event lines
# ---------------------------------------------------------------------------

GATE_WINDOW_S = 86_400
GATE_KEYS = 14  # two more than the tier table has


def gate_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in requests: user turns with a key per conversation (two keys are
    unknown), a minute between conversations, tokens estimated from the text."""
    c = guard_input(table(spark, sf, "conversations")).filter(F.col("role") == "user")
    t_in, t_out = L.estimate_tokens(F.length("text"), F.length("text"))
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
                    F.concat(F.lit("key-"), (F.col("conv_id") % GATE_KEYS).cast("string")).alias("api_key"),
                    F.timestamp_seconds(start + F.col("conv_id") * 60 + F.col("turn")).alias("created_at"),
                    t_in.alias("input_tokens"), t_out.alias("output_tokens"), F.lit(False).alias("cache_hit"), F.lit(False).alias("aborted"), "text")


SQL_GATE = f"""{guard_sql()},
gr AS (
  SELECT conv_id * 1000 + turn AS request_id, conv_id, turn, 'key-' || (conv_id % {GATE_KEYS}) AS api_key,
         floor((epoch(TIMESTAMP '2024-01-01 00:00:00') + conv_id * 60 + turn) / {GATE_WINDOW_S}) AS bucket,
         CAST(floor(length(text) / 4) AS BIGINT) AS tin, CAST(greatest(1, floor(length(text) / 4)) AS BIGINT) AS tout, conv_id * 60 + turn AS t
  FROM src WHERE role = 'user'),
tier AS (SELECT 'key-' || i AS api_key, CASE i % 3 WHEN 0 THEN 5000 WHEN 1 THEN 20000 ELSE 100000 END AS lim FROM range(12) r(i)),
gb AS (SELECT gr.*, lim, coalesce(sum(tin + tout) OVER (PARTITION BY gr.api_key, bucket ORDER BY t, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
       FROM gr LEFT JOIN tier USING (api_key))
"""


@register("guard_chain", sql=f"""WITH {SQL_GATE}
SELECT gb.request_id, coalesce(CASE WHEN lim IS NULL THEN 'unknown_key' WHEN before >= lim THEN 'rate_limited' END, s.reject_reason) AS reject_reason,
       gb.tin AS input_tokens, gb.tout AS output_tokens
FROM gb JOIN guarded s ON s.conv_id = gb.conv_id AND s.turn = gb.turn AND s.role = 'user'""", ops="FIL10 FIL9 FUN6 LLM3 FIL6 FIL7")
def guard_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Key, rate limit, length, pattern: the first gate that fails."""
    r = gate_requests(spark, sf)
    _, unknown = L.admit(r, tiers(spark))
    rate = L.rate_limit_replay(r, tiers(spark), GATE_WINDOW_S).select("request_id", "allowed")
    j = r.join(rate, "request_id").join(unknown.select("request_id", F.lit(True).alias("_unknown")), "request_id", "left")
    prior = F.when(F.col("_unknown"), F.lit("unknown_key")).when(~F.col("allowed"), F.lit("rate_limited"))
    return L.guard(j, "text", prior_reason=prior).select("request_id", "reject_reason", "input_tokens", "output_tokens")


@register("admission", sql=f"""WITH {SQL_GATE} SELECT lim IS NOT NULL AS admitted, count(*) AS n FROM gb GROUP BY 1""", ops="FIL9 JON6")
def admission(spark: SparkSession, sf: str) -> DataFrame:
    yes, no = L.admit(gate_requests(spark, sf), tiers(spark))
    n = lambda d, v: d.groupBy(F.lit(v).alias("admitted")).agg(F.count(F.lit(1)).alias("n"))
    return n(yes, True).unionByName(n(no, False))


GAUGE_AT = "2024-01-15 12:00:00"


@register("service_gauges", sql=f"""WITH req AS ({REQUEST_LOG_SQL}), r AS (SELECT *, epoch_us(TIMESTAMP '{GAUGE_AT}') - epoch_us(created_at) AS age FROM req WHERE created_at <= TIMESTAMP '{GAUGE_AT}')
SELECT model, count(*) AS total, CAST(sum(CAST(cache_hit AS INTEGER)) AS BIGINT) AS hits, CAST(sum(CAST(NOT cache_hit AS INTEGER)) AS BIGINT) AS misses,
       CAST(sum(CAST(aborted AS INTEGER)) AS BIGINT) AS aborted, CAST(sum(CAST(age < latency_ms * 1000000 AS INTEGER)) AS BIGINT) AS active_streams,
       CAST(sum(CAST(NOT cache_hit AND NOT failed AND NOT aborted AND age < 86400000000 AS INTEGER)) AS BIGINT) AS live_entries
FROM r GROUP BY model""", ops="AGG25")
def service_gauges(spark: SparkSession, sf: str) -> DataFrame:
    return L.service_gauges(requests(spark, sf), GAUGE_AT, ttl_s=86_400)


@register("event_lines", sql="""
SELECT conv_id, turn, md5('data: ' || to_json({'type': 'token', 'content': text}) || chr(10) || chr(10)) AS line_md5 FROM conversations""", ops="FUN10")
def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.md5(L.sse_event("token", F.col("text"))).alias("line_md5"))


# ---------------------------------------------------------------------------
# Characters, bytes, chunks, tables
# ---------------------------------------------------------------------------

BLOCK = 128


@register("char_codec", sql=f"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_ids, CASE WHEN length(text) > {BLOCK} THEN CAST(floor((length(text) - {BLOCK} - 1) / {BLOCK}) + 1 AS BIGINT) ELSE 0 END AS blocks,
       true AS same FROM documents""", ops="FUN21 TXT14 AGG20")
def char_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to ids, to training blocks, and back. The ids are stored once; each
    step's result is brought down to a few bytes a row where it lies (texts to
    their SHA-256), and only those are joined."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = stored(LM.vocabulary(docs), "vocabulary")
    ids = stored(LM.encode(docs, vocab), "ids")
    blocks = LM.training_blocks(ids, BLOCK).filter(F.slice("x", 2, BLOCK - 1) == F.slice("y", 1, BLOCK - 1)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"))
    digest = F.sha2("text", 256)
    back = LM.decode(ids, vocab).select("doc_id", digest.alias("_back"))
    j = docs.select("doc_id", digest.alias("_text")).join(ids.select("doc_id", F.size("ids").alias("n_ids")), "doc_id").join(back, "doc_id").join(blocks, "doc_id", "left")
    return j.select("doc_id", "n_ids", F.coalesce("blocks", F.lit(0)).alias("blocks"), (F.col("_text") == F.col("_back")).alias("same"))


@register("decode_bytes", sql="""
SELECT doc_id, 'utf-8' AS encoding, doc_id % 2 = 1 AS had_bom, length(text) AS char_count, md5(text) AS text_md5 FROM documents
UNION ALL
SELECT doc_id + 1000000000, 'windows-1251', false, length(t), md5(t) FROM (SELECT doc_id, 'документ номер ' || doc_id || ' содержит текст' AS t FROM documents)""", ops="TXT1")
def decode_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every document in UTF-8 (every other one with a mark in front),
    beside a Cyrillic note per document in its one-byte encoding."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    utf = F.encode("text", "UTF-8")
    plain = d.select("doc_id", F.when(F.col("doc_id") % 2 == 1, F.concat(F.unhex(F.lit("EFBBBF")), utf)).otherwise(utf).alias("content"))
    note = F.concat(F.lit("документ номер "), F.col("doc_id").cast("string"), F.lit(" содержит текст"))
    notes = d.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), F.encode(note, "windows-1251").alias("content"))
    t = D.decode_files(plain.unionByName(notes))
    return t.select("doc_id", "encoding", "had_bom", F.col("char_count").cast("bigint").alias("char_count"), F.md5("text").alias("text_md5"))


@register("chunk_checks", sql="SELECT doc_id, true AS within_size, true AS inside, true AS words_kept FROM documents WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) > 0", ops="TXT10 UDF5")
def chunk_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What every recursive chunking must keep, for every document: chunks are
    within the size, parts of the text, and hold all its words."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ch = D.recursive_chunks(docs, CHUNK_SIZE, CHUNK_OVERLAP)
    words = lambda c: F.filter(F.array_distinct(F.split(c, r"\s+")), lambda w: F.length(w) > 0)
    j = ch.join(docs, "doc_id").withColumns({"_in": F.instr("text", F.col("chunk")) > 0, "_w": words(F.col("chunk"))})
    per = j.groupBy("doc_id").agg(F.max("length").alias("_max"), F.bool_and("_in").alias("inside"), F.array_distinct(F.flatten(F.collect_list("_w"))).alias("_w"))
    kept = F.size(F.array_except(F.filter(words(F.col("text")), lambda w: F.length(w) < CHUNK_SIZE), F.col("_w"))) == 0
    return per.join(docs, "doc_id").select("doc_id", (F.col("_max") <= CHUNK_SIZE).alias("within_size"), "inside", kept.alias("words_kept"))


SQL_CHUNKS = f"""
cd AS (SELECT doc_id, source, text, CASE WHEN length(text) <= {CHUNK_SIZE} THEN 1
                 ELSE CAST(ceil((length(text) - {CHUNK_SIZE}) / {CHUNK_SIZE - CHUNK_OVERLAP}) AS INTEGER) + 1 END AS cnt FROM documents),
ch AS (SELECT doc_id, source, i AS chunk_index, substring(text, i * {CHUNK_SIZE - CHUNK_OVERLAP} + 1, {CHUNK_SIZE}) AS chunk
       FROM (SELECT *, CAST(unnest(range(cnt)) AS INTEGER) AS i FROM cd)),
pt AS (SELECT sha256(source || '|' || doc_id || '|' || chunk_index) AS point_id, *,
              len(regexp_extract_all(chunk, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]')) AS token_count,
              nullif(trim(regexp_extract(chunk, '(?m)^[ \\t]*#{{1,3}}[ \\t]+(.+?)[ \\t]*$', 1)), '') AS section FROM ch)
"""


def fixed_chunk_points(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    ch = D.fixed_chunks(docs, CHUNK_SIZE, CHUNK_OVERLAP).join(docs.select("doc_id", "source"), "doc_id")
    return D.chunk_points(ch)


@register("chunk_index", sql=f"""WITH {SQL_CHUNKS}
SELECT point_id, doc_id, chunk_index, CAST(token_count AS INTEGER) AS token_count, section,
       CASE WHEN len(regexp_extract_all(lower(chunk), '[a-z0-9]+')) > 0 THEN CAST(1 AS DOUBLE) END AS norm FROM pt""", ops="TXT11 FUN4 RET9")
def chunk_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows of fixed-window chunks: id, section, tokens, unit embedding."""
    p = fixed_chunk_points(spark, sf)
    return p.select("point_id", "doc_id", "chunk_index", "token_count", "section", F.round(V.l2_norm("embedding"), 6).alias("norm"))


@register("chunk_statistics", sql=f"""WITH {SQL_CHUNKS}
SELECT count(*) AS chunks, CAST(trunc(avg(token_count)) AS BIGINT) AS avg_length, CAST(min(token_count) AS INTEGER) AS min_length,
       CAST(max(token_count) AS INTEGER) AS max_length FROM pt""", ops="AGG18")
def chunk_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return D.chunk_stats(fixed_chunk_points(spark, sf), "token_count")


@register("order_tables", sql="""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS p,
                  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS row_no FROM orders)
SELECT o_custkey AS file, row_no, 'key' AS field, CAST(o_orderkey AS VARCHAR) AS value FROM o UNION ALL SELECT o_custkey, row_no, 'status', o_orderstatus FROM o""", ops="TXT5")
def order_tables(spark: SparkSession, sf: str) -> DataFrame:
    """An HTML table of orders per customer, parsed back into records."""
    tag = lambda t, c: F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>"))
    cells = F.concat(tag("td", F.col("o_orderkey").cast("string")), tag("td", tag("b", F.col("o_orderstatus"))))
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("file")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", tag("tr", cells).alias("r")))).alias("_r"))
    head = F.lit("<html><body><p>orders</p><table class='o'>\n<tr><th>key</th><th> status </th></tr>")
    pages = rows.select("file", F.concat(head, F.array_join(F.transform("_r", lambda x: x["r"]), "\n"), F.lit("</table></body></html>")).alias("html"))
    rec = D.records_from_cells(D.html_cells(pages))
    return rec.select("file", F.col("row_no").cast("int").alias("row_no"), F.explode("record").alias("field", "value"))


# ---------------------------------------------------------------------------
# Graph: one expansion, unexpanded nodes
# ---------------------------------------------------------------------------

_EDGES = """edges AS (SELECT DISTINCT source, target FROM (
    SELECT p_type AS source, p_brand AS target FROM part UNION ALL SELECT p_brand, split_part(p_name, ' ', 2) FROM part
    UNION ALL SELECT split_part(p_name, ' ', 2), split_part(p_name, ' ', 1) FROM part) WHERE target IS NOT NULL AND target <> '')"""


def _roots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_type").alias("name")).distinct()


@register("expand_one", sql=f"""WITH {_EDGES}, k AS (SELECT lower(min(p_type)) AS k FROM part)
SELECT lower(target) AS key, min(target) AS name, k.k AS parent FROM edges, k
WHERE lower(source) = k.k AND lower(target) NOT IN (SELECT lower(p_type) FROM part) GROUP BY ALL""", ops="GRA2")
def expand_one(spark: SparkSession, sf: str) -> DataFrame:
    roots, _ = G.expand(part_edges(spark, sf), _roots(spark, sf), 0)
    first = table(spark, sf, "part").agg(F.min("p_type")).first()[0]
    return G.expand_one(part_edges(spark, sf), roots, first)


@register("unexpanded_nodes", sql=f"""WITH {_EDGES},
r AS (SELECT DISTINCT lower(p_type) AS key FROM part),
one AS (SELECT DISTINCT lower(target) AS key FROM edges WHERE lower(source) IN (SELECT key FROM r) AND lower(target) NOT IN (SELECT key FROM r))
SELECT key, 1 AS level FROM one""", ops="FIL15 GRA1")
def unexpanded_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """After one level, the nodes that the next level would expand."""
    nodes, _ = G.expand(part_edges(spark, sf), _roots(spark, sf), 1)
    return G.unexpanded(nodes, nodes.filter("level = 0").select("key"), MAX_DEPTH).select("key", F.col("level").cast("int").alias("level"))
