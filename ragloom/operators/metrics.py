"""Evaluation of ranked lists and result tables (AGG5-AGG10, RET11-RET13, WIN2, WIN5).

Two different "recall@k" exist in the source projects (S1) and both are kept:
``hit_rate_at_k`` is 1 when any relevant document is in the top k (averaged
over every evaluation query, S3), ``recall_at_k`` is ``hits / min(k, |rel|)``
(averaged over queries that have relevant documents). MRR is truncated at the
largest k (S2). Averages are rounded to 4 places after averaging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retrieval_metrics(ranked: DataFrame, qrels: DataFrame, ks: Sequence[int] = (1, 5, 10), by: Sequence[str] = (),
                      qid: str = "qid", did: str = "did", rank: str = "rank", decimals: int = 4) -> DataFrame:
    """RET11 / AGG8 / AGG9 / JON2: one row of metrics per ``by`` group.

    ``qrels`` lists the relevant ``(qid, did)`` pairs (plus the ``by`` columns
    when the evaluation universe differs per group); its distinct queries are
    the evaluation set, so a query with no retrieved rows counts as a miss.
    Work is two joins and two aggregations keyed by query: no per-query list is
    ever collected.
    """
    by = list(by)
    max_k = max(ks)
    rel = qrels.select(*by, F.col(qid).alias("qid"), F.col(did).alias("did")).distinct()
    rel_n = rel.groupBy(*by, "qid").agg(F.count(F.lit(1)).alias("n_rel"))
    hits = (
        ranked.select(*by, F.col(qid).alias("qid"), F.col(did).alias("did"), F.col(rank).alias("rank"))
        .filter(F.col("rank") <= max_k)
        .join(rel, [*by, "qid", "did"], "left_semi")
    )
    aggs = [F.min("rank").alias("first_hit")]
    for k in ks:
        aggs.append(F.sum((F.col("rank") <= k).cast("int")).alias(f"hits_{k}"))
    per_q = hits.groupBy(*by, "qid").agg(*aggs)
    per_q = rel_n.join(per_q, [*by, "qid"], "left")
    out = []
    for k in ks:
        out.append(F.round(F.avg(F.when(F.col("first_hit") <= k, 1.0).otherwise(0.0)), decimals).alias(f"hit_rate_at_{k}"))
    out.append(F.round(F.avg(F.when(F.col("first_hit") <= max_k, 1.0 / F.col("first_hit")).otherwise(0.0)), decimals)
               .alias(f"mrr_at_{max_k}"))
    for k in ks:
        out.append(F.round(F.avg(F.coalesce(F.col(f"hits_{k}"), F.lit(0)) / F.least(F.lit(k), F.col("n_rel"))), decimals)
                   .alias(f"recall_at_{k}"))
    return per_q.groupBy(*by).agg(F.count(F.lit(1)).alias("n_queries"), *out)


def recall_vs_exact(approx: DataFrame, exact: DataFrame, k: int = 10, by: str | None = None, values: Sequence = (),
                    qid: str = "qid", did: str = "did", rank: str = "rank", decimals: int = 4) -> DataFrame:
    """AGG10 / JON3 / SET2: overlap of an approximate top-k with the exact top-k,
    over ``min(k, |exact|)``. Every query with an exact result counts, one
    without any approximate result as 0; queries with an empty exact set are
    skipped (S4). ``by`` names a column of settings in ``approx`` and
    ``values`` lists the settings to compare."""
    ex = exact.filter(F.col(rank) <= k).select(F.col(qid).alias("qid"), F.col(did).alias("did"))
    ex_n = ex.groupBy("qid").agg(F.count(F.lit(1)).alias("n_exact"))
    if by:
        ex_n = ex_n.withColumn(by, F.explode(F.array(*[F.lit(v) for v in values])))
    by = [by] if by else []
    ap = approx.filter(F.col(rank) <= k).select(*by, F.col(qid).alias("qid"), F.col(did).alias("did"))
    inter = ap.join(ex, ["qid", "did"]).groupBy(*by, "qid").agg(F.count(F.lit(1)).alias("n_common"))
    per_q = ex_n.join(inter, [*by, "qid"], "left").fillna(0, ["n_common"])
    return per_q.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg(F.col("n_common") / F.least(F.lit(k), F.col("n_exact"))), decimals).alias(f"recall_vs_exact_at_{k}"),
    )


def latency_summary(df: DataFrame, value: str = "latency_ms", by: Sequence[str] = (), per: str | None = None,
                    repeat: str = "median", decimals: int = 4) -> DataFrame:
    """AGG5 / AGG6: p50/p95/p99 (linear interpolation, = numpy default), mean,
    min, max. With ``per`` (a query id) the repeats of one query are first
    reduced by their median or by their minimum (the two conventions of the
    source benchmarks)."""
    by = list(by)
    if per is not None:
        red = F.median(value) if repeat == "median" else F.min(value)
        df = df.groupBy(*by, per).agg(red.alias(value))
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.percentile(v, 0.5), decimals).alias("p50"),
        F.round(F.percentile(v, 0.95), decimals).alias("p95"),
        F.round(F.percentile(v, 0.99), decimals).alias("p99"),
        F.round(F.avg(v), decimals).alias("mean"),
        F.round(F.min(v), decimals).alias("min"),
        F.round(F.max(v), decimals).alias("max"),
    )


SKETCH_K = 400


def quantile_sketch(df: DataFrame, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """AGG5 / AGG4, approximate: one KLL sketch per group as a column ``sketch``
    (a few kilobytes whatever the group holds), which merges with others."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AGG5: sketches of finer groups (hours) merged to coarser ones (days, keys)
    without the rows."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_summary(sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[tuple[str, float]] = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))) -> DataFrame:
    """AGG5: ``n`` and the quantiles of every sketch. With the default size the
    rank of an answer is within 1 % of the asked one (99 % of the time, single
    queries); groups of up to ``SKETCH_K`` values are exact."""
    return sketches.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"),
                           *[F.kll_sketch_get_quantile_double("sketch", F.lit(q).cast("double")).alias(name) for name, q in quantiles])


def index_percentile(values_sorted: Column, q: float) -> Column:
    """AGG4 on a sorted array: ``sorted[int(n*q)]`` (0-based)."""
    n = F.size(values_sorted)
    return F.element_at(values_sorted, (F.floor(n * F.lit(q)) + 1).cast("int"))


def pareto(df: DataFrame, cost: str, quality: str, by: Sequence[str] = (), tie: str | None = None,
           flag: str = "on_frontier") -> DataFrame:
    """WIN2 / RET12: a point is on the frontier iff its quality is strictly
    above every cheaper point's (S28). Points are visited by cost asc, quality
    desc, then ``tie``; rows with a null quality are dropped first."""
    order = [F.col(cost).asc(), F.col(quality).desc()] + ([F.col(tie).asc()] if tie else [])
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.max(F.col(quality)).over(w)
    d = df.filter(F.col(quality).isNotNull() & F.col(cost).isNotNull())
    return d.withColumn(flag, F.col(quality) > F.coalesce(best_before, F.lit(float("-inf"))))


def knee(df: DataFrame, size: str, metrics: Sequence[str], latency: str | None = None, drop: float = 0.20,
         growth: float = 100.0, by: Sequence[str] = (), decimals: int = 4) -> DataFrame:
    """RET13 / WIN5: compare every size with the smallest one (S27).

    Long output ``(size, metric, base, now, magnitude)``: a quality metric is
    reported when it fell by at least ``drop`` relative to the baseline, the
    latency when it grew ``growth`` times over ``max(base, 0.01)``.
    """
    by = list(by)
    names = list(metrics) + ([latency] if latency else [])
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("now")) for m in names]))
    long = df.select(*by, F.col(size).alias("size"), stack.alias("_m")).select(*by, "size", "_m.metric", "_m.now")
    w = Window.partitionBy(*by, "metric").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    long = long.withColumn("base", F.first("now").over(w)).withColumn("_first", F.min("size").over(w))
    is_lat = F.col("metric") == F.lit(latency) if latency else F.lit(False)
    mag = F.when(is_lat, F.col("now") / F.greatest(F.col("base"), F.lit(0.01))).otherwise(
        (F.col("base") - F.col("now")) / F.col("base"))
    fired = F.when(is_lat, mag >= growth).otherwise(mag >= drop)
    long = long.filter((F.col("size") != F.col("_first")) & fired).drop("_first")
    return long.withColumn("magnitude", F.round(mag, decimals))


def throughput(df: DataFrame, ms: str = "latency_ms", by: Sequence[str] = (), wall_s: float | None = None) -> DataFrame:
    """AGG7: queries per second, ``n / sum(ms) * 1000``, or ``n / wall_s`` when
    the wall time of the whole run is given (the two forms of the source)."""
    n = F.count(F.lit(1))
    q = n / F.lit(wall_s) if wall_s else n / F.sum(ms) * 1000.0
    return df.groupBy(*by).agg(n.alias("n"), F.round(q, 3).alias("qps"))


def max_per_family(df: DataFrame, family: str, value: str) -> DataFrame:
    """AGG27: largest value per family."""
    return df.groupBy(family).agg(F.max(value).alias(f"max_{value}"))


def compare_to_baseline(baseline: DataFrame, variants: DataFrame, size: str, retriever: str, metrics: Sequence[str],
                        order: Sequence[str], decimals: int = 4) -> DataFrame:
    """JON14: first row per (size, retriever) of the union of baseline and
    variant results (baseline rows first, then by ``order``), each joined with
    the first baseline row of its size."""
    listed = baseline.withColumn("_list", F.lit(0)).unionByName(variants.withColumn("_list", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(size, retriever).orderBy("_list", *order)
    first = listed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_list")
    base = baseline.groupBy(size).agg(*[F.min_by(m, F.struct(*order)).alias(f"base_{m}") for m in metrics])
    out = first.join(base, size, "left")
    for m in metrics:
        out = out.withColumn(f"delta_{m}", F.round(F.col(m) - F.col(f"base_{m}"), decimals))
    return out


def stream_timing(tokens: DataFrame, request: str = "request_id", ts: str = "ts", start: str = "start_ts") -> DataFrame:
    """AGG29 / WIN9: per request time to first token, mean and max gap between
    tokens (``ts - lag(ts)`` inside the request), tokens per second and total
    time. Windows are per request (bounded by one answer)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(request).orderBy(ts)
    t = tokens.withColumn("_us", us).withColumn("_gap", (F.col("_us") - F.lag("_us").over(w)) / 1000.0)
    g = t.groupBy(request).agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.count(F.lit(1)).alias("tokens"),
        F.avg("_gap").alias("mean_gap_ms"), F.max("_gap").alias("max_gap_ms"),
        F.first(F.unix_micros(F.col(start).cast("timestamp"))).alias("_start"))
    total = (F.col("_last") - F.col("_start")) / 1000.0
    return g.select(request, ((F.col("_first") - F.col("_start")) / 1000.0).alias("ttft_ms"),
                    F.round("mean_gap_ms", 3).alias("mean_gap_ms"), F.round("max_gap_ms", 3).alias("max_gap_ms"), "tokens",
                    F.round(F.when(total > 0, F.col("tokens") / (total / 1000.0)), 3).alias("tokens_per_s"),
                    total.alias("total_ms"))
