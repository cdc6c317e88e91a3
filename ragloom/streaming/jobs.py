"""Structured Streaming twins of the batch jobs (STR1-STR3, STR6-STR9, STR10 in
windows); those with keyed state and timers are in ``stateful``.

The rules run as event-time streaming queries with watermarks. Late rows (older
than the watermark) are dropped by Spark; :func:`run_counted` reports how many.
Every job returns a streaming DataFrame; :func:`run_to_table` drives one to
completion into a parquet folder under the shared checkpoint directory
(exactly-once file sink + checkpoint), which is how the registered queries and
the tests read them back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import llmops as L
from ..operators.common import ensure_parallel
from ..session import make_folder, move, scratch_path


def stream_token_windows(log: DataFrame, window: str = "60 seconds", watermark: str = "120 seconds") -> DataFrame:
    """STR1 / FUN12: tokens per key per tumbling window; a key's window state lives
    for the watermark delay (2 x window in the source)."""
    tokens = (F.col("input_tokens") + F.col("output_tokens")).cast("bigint")
    return (log.withWatermark("created_at", watermark)
            .groupBy(F.window("created_at", window).alias("w"), "api_key")
            .agg(F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("requests"))
            .select(F.col("w.start").alias("window_start"), "api_key", "tokens", "requests"))


def stream_rolling_usage(log: DataFrame, length: str = "24 hours", slide: str = "1 hour",
                         watermark: str = "24 hours") -> DataFrame:
    """STR2: rolling usage per key over sliding windows."""
    tokens = (F.col("input_tokens") + F.col("output_tokens")).cast("bigint")
    return (log.withWatermark("created_at", watermark)
            .groupBy(F.window("created_at", length, slide).alias("w"), "api_key")
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("tokens"))
            .select(F.col("w.start").alias("window_start"), "api_key", "requests", "tokens"))


def stream_dedupe(log: DataFrame, key: str = "request_id", ts: str = "created_at", watermark: str = "1 hour") -> DataFrame:
    """STR3: exactly one row per request id among redeliveries that arrive
    within the watermark (at-least-once sources)."""
    return log.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def stream_guard(turns: DataFrame, text: str = "text") -> DataFrame:
    """STR6: stateless guard projection; route with :func:`guard_sinks`."""
    g = L.guard(turns, text)
    answer = F.when(F.col("role") == "assistant", F.lower(text))
    return g.withColumn("_answer", answer).withColumn("leak_marker", L.leak_scan(F.col(text), low=F.col("_answer"))).drop("_answer")


def guard_sinks(rejected_path: str, clean_path: str) -> Callable[[DataFrame, int], None]:
    """STR6 / SNK7: one micro-batch -> suspicious rows as JSON lines (preview of
    200 characters, of a leaking response 300), clean rows as parquet. Writes are keyed by batch id so a
    replayed batch overwrites its own output (idempotent)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        bad = batch.filter(F.col("reject_reason").isNotNull() | F.col("leak_marker").isNotNull())
        bad.select("conv_id", "turn", "role", "reject_reason", "pattern", "snippet", "leak_marker",
                   F.length("text").alias("input_len"), F.substring("text", 1, 200).alias("input_preview"),
                   F.when(F.col("leak_marker").isNotNull(), F.substring("text", 1, 300)).alias("response_preview")) \
            .write.mode("overwrite").json(f"{rejected_path}/batch={batch_id}")
        batch.filter(F.col("reject_reason").isNull() & F.col("leak_marker").isNull()) \
            .write.mode("overwrite").parquet(f"{clean_path}/batch={batch_id}")
        batch.unpersist()

    return fn


def stream_gauges(log: DataFrame) -> DataFrame:
    """STR8 / AGG25: running service counters (total, hits, misses, failures,
    aborted) per model; update mode."""
    return log.groupBy("model").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.col("cache_hit").cast("int")).alias("hits"),
        F.sum((~F.col("cache_hit")).cast("int")).alias("misses"), F.sum(F.col("failed").cast("int")).alias("failures"),
        F.sum(F.col("aborted").cast("int")).alias("aborted"))


def stream_span_batches(spans: DataFrame, window: str = "2 seconds", watermark: str = "10 seconds") -> DataFrame:
    """STR10: spans grouped per trace in short event-time windows (the
    client's flush interval)."""
    return (spans.withWatermark("start_ts", watermark)
            .groupBy("trace_id", F.window("start_ts", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("spans"), F.sort_array(F.collect_list(F.struct("start_ts", "name"))).alias("batch"))
            .select("trace_id", F.col("w.start").alias("window_start"), "spans",
                    F.array_join(F.transform("batch", lambda x: x["name"]), ">").alias("names")))


def file_arrivals(spark: SparkSession, uploads: str, glob: str = "*.pdf") -> DataFrame:
    """STR7 / SRC11: new files under ``uploads`` as a stream of
    ``(path, modificationTime, length, content)``; each file is seen once per
    checkpoint, a path that comes again within a day of event time is dropped
    (the state holds one day)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(uploads)
            .withWatermark("modificationTime", "1 day").dropDuplicatesWithinWatermark(["path"]))


def processed_key(path: str = "path") -> F.Column:
    """SNK8: ``uploads/`` -> ``processed/`` and ``.pdf`` -> ``.txt``."""
    return F.regexp_replace(F.regexp_replace(F.col(path), "/uploads/", "/processed/"), r"\.pdf$", ".txt")


class Arrivals:
    """A table that arrives part after part: the source of a stream over a
    growing folder. Each part is written by as many tasks as its scan has, or
    dealt over the cluster where that is less (so a micro-batch has a file for
    every core), and moved into the folder at once: a micro-batch sees whole parts."""

    def __init__(self, spark: SparkSession, parts: Sequence[DataFrame]):
        self.spark, self.parts = spark, list(parts)
        self.path = scratch_path(spark, f"streams/in-{uuid.uuid4().hex}")
        make_folder(spark, self.path)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.parts[0].schema).option("recursiveFileLookup", "true").parquet(self.path)

    def deliver(self) -> Iterator[None]:
        """Write the next part; once for every part."""
        for i, part in enumerate(self.parts):
            ensure_parallel(part).write.parquet(f"{self.path}-staged/part={i}")
            move(self.spark, f"{self.path}-staged/part={i}", f"{self.path}/part={i}")
            yield


@dataclass
class Run:
    """Where the output is, and the rows that went in, were dropped as late,
    and were dropped as repeats, over all micro-batches; ``state_rows`` after
    each of them."""

    path: str
    rows: int
    late: int
    repeats: int
    state_rows: list[int]


def run_counted(stream: DataFrame, name: str, mode: str = "append", foreach_batch: Callable[[DataFrame, int], None] | None = None,
                arrivals: Arrivals | None = None, settle: bool = False, count_state: bool = True) -> Run:
    """Run a streaming DataFrame to completion into a fresh parquet folder under
    the shared checkpoint directory, and count what its state operators dropped
    (§2.12: rows behind the watermark; a grouped count drops them after its
    partial aggregation, so it counts groups there).

    Without ``arrivals`` the input folder is read once (``availableNow``). With
    it, the parts arrive one after the other, each when the one before has been
    processed; with ``settle`` a batch without rows follows each, in which timers
    up to the new watermark fire (else they wait for the next rows).

    The state store looks every key up once more to know how many it holds;
    without ``count_state`` it does not, and ``state_rows`` are 0.

    Update-mode aggregates go through ``foreachBatch`` as an upsert log (one
    file set per batch id); read them back with :func:`latest_rows`. A query's
    state is laid out over the session's shuffle partitions, for the life of
    its checkpoint."""
    spark = stream.sparkSession
    run = uuid.uuid4().hex[:12]
    out = scratch_path(spark, f"streams/{name}-{run}/out")
    w = stream.writeStream.option("checkpointLocation", scratch_path(spark, f"streams/{name}-{run}/checkpoint")).outputMode(mode)
    if arrivals is None:
        w = w.trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif mode == "append":
        w = w.format("parquet").option("path", out)
    else:
        def upsert(batch: DataFrame, batch_id: int, out=out) -> None:
            batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        w = w.foreachBatch(upsert)
    options = {"spark.sql.streaming.numRecentProgressUpdates": "10000", "spark.sql.streaming.noDataMicroBatches.enabled": str(settle or arrivals is None).lower(),
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": str(count_state).lower()}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    q = w.start()
    for k, v in before.items():  # the query has its own copy
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if arrivals is None:
        q.awaitTermination()
    else:
        try:
            for _ in arrivals.deliver():
                q.processAllAvailable()
        finally:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _counted(out, [json.loads(p.json) for p in q.recentProgress])


def _counted(path: str, progress: list[dict]) -> Run:
    batches = {p["batchId"]: p for p in progress}  # an idle moment reports its batch again
    state = [op for _, p in sorted(batches.items()) for op in p["stateOperators"]]
    return Run(path, sum(p["numInputRows"] for p in batches.values()), sum(op.get("numRowsDroppedByWatermark", 0) for op in state),
               sum(op.get("customMetrics", {}).get("numDroppedDuplicateRows", 0) for op in state), [op["numRowsTotal"] for op in state])


def run_to_table(stream: DataFrame, name: str, mode: str = "append", foreach_batch: Callable[[DataFrame, int], None] | None = None,
                 arrivals: Arrivals | None = None, settle: bool = False) -> str:
    """The folder of :func:`run_counted`'s output."""
    return run_counted(stream, name, mode, foreach_batch, arrivals, settle, count_state=False).path


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Latest version of every key from an upsert log written by
    :func:`run_to_table` in update mode."""
    df = spark.read.option("basePath", path).parquet(path)
    cols = [c for c in df.columns if c not in ("_batch", "batch")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in cols if c not in keys]), "batch").alias("_r"))
    return last.select(*keys, "_r.*")


def stream_first_token(tokens: DataFrame, request: str = "request_id", ts: str = "ts", start: str = "start_ts",
                       watermark: str = "5 minutes") -> DataFrame:
    """STR9 / AGG29: per request, time to first token, token count, total time
    and tokens per second as the token stream arrives (update mode; a request
    is final once the watermark passes its last token)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    g = (tokens.withWatermark(ts, watermark).groupBy(request)
         .agg(F.min(us).alias("_first"), F.max(us).alias("_last"), F.count(F.lit(1)).alias("tokens"),
              F.min(F.unix_micros(F.col(start).cast("timestamp"))).alias("_start")))
    total = (F.col("_last") - F.col("_start")) / 1000.0
    return g.select(request, ((F.col("_first") - F.col("_start")) / 1000.0).alias("ttft_ms"), "tokens",
                    total.alias("total_ms"),
                    F.round(F.when(total > 0, F.col("tokens") / (total / 1000.0)), 3).alias("tokens_per_s"))
