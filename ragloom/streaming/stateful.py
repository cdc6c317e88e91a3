"""Keyed state with event-time timers (STR4, STR5, STR8, STR10).

Each processor keeps little state per key, takes the rows of a micro-batch
frame by frame, and uses a timer for what happens without a row: an entry that
expires, a breaker that reopens, a batch that is due, a gauge that falls. Timers
fire when the watermark passes them. State lives in the RocksDB state store
(``ragloom.session.SESSION_DEFAULTS`` names it).

Rows of one micro-batch are applied in event-time order; a row that comes in a
later micro-batch than rows after it, but within the watermark, is applied when
it comes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..operators.llmops import Breaker
from ..operators.semantic_cache import LiveEntries, cache_replay_sequential, direction


def _needs_rocksdb(df: DataFrame) -> None:
    if "RocksDB" not in df.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass"):
        raise ValueError("set spark.sql.streaming.stateStore.providerClass to the RocksDB provider")


def _us(column: str | Column) -> Column:
    return F.unix_micros((F.col(column) if isinstance(column, str) else column).cast("timestamp"))


def _due_ms(us: int) -> int:
    return -(-us // 1000)


class _Timed(StatefulProcessor):
    """One timer a key at most: the earliest moment at which something is due."""

    def init(self, handle) -> None:
        self.handle = handle

    def timer_at(self, us: int | None, fired_ms: int = -1) -> None:
        """Make sure of a timer at ``us`` or before. ``fired_ms``: the watermark
        in a timer's own call, where that timer is still listed."""
        if us is None:
            return
        due = _due_ms(us)
        times = [t for t in self.handle.listTimers() if t > fired_ms]
        if any(t <= due for t in times):
            return
        for t in times:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(due)

    def close(self) -> None:
        pass


# ---------------------------------------------------------------------------
# STR5: semantic cache
# ---------------------------------------------------------------------------

CACHE_OUT = "request_id long, hit boolean, matched_request_id long, similarity double, age_seconds long"


class CacheProcessor(_Timed):
    """List state of the live entries of one cache in time order."""

    def __init__(self, threshold: float, ttl_us: int, decimals: int):
        self.threshold, self.ttl_us, self.decimals = threshold, ttl_us, decimals

    def init(self, handle) -> None:
        super().init(handle)
        self.entries = handle.getListState("entries", "us long, rid long, v array<double>")

    def _held(self) -> list[tuple]:
        return list(self.entries.get()) if self.entries.exists() else []

    def _keep(self, held: list[tuple], fired_ms: int = -1) -> None:
        if held:
            self.entries.put(held)
            self.timer_at(held[0][0] + self.ttl_us, fired_ms)
        else:  # the store keeps no empty lists
            self.entries.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        live = LiveEntries(self.ttl_us, self.threshold, self.decimals)
        for us, rid, v in self._held():
            live.store(us, rid, np.asarray(v))
        asked = sorted((us, rid, v) for pdf in rows for us, rid, v in zip(pdf["us"].tolist(), pdf["request_id"].tolist(), pdf["v"], strict=True))
        out = []
        for us, rid, v in asked:
            x = direction(v)
            best = live.ask(us, x) if x is not None else None
            out.append((rid, best is not None, *((best[1], best[0], us // 1_000_000 - best[2] // 1_000_000) if best else (None, None, None))))
            if x is not None and best is None:
                live.store(us, rid, x)
        live.expire(asked[-1][0])
        at = slice(live.first, live.end)
        self._keep(list(zip(live.us[at].tolist(), live.ids[at].tolist(), live.matrix[at].tolist(), strict=True)))
        frame = pd.DataFrame(out, columns=["request_id", "hit", "matched_request_id", "similarity", "age_seconds"])
        yield frame.astype({"matched_request_id": "Int64", "age_seconds": "Int64", "similarity": "float64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Entries that no later request can reach leave the state."""
        now = timerValues.getCurrentWatermarkInMs()
        self._keep([tuple(e) for e in self._held() if e[0] + self.ttl_us > now * 1000], now)
        return iter(())


def stream_cache(requests: DataFrame, block: str, threshold: float = 0.92, ttl_s: int = 3600, id_col: str = "request_id", ts: str = "created_at",
                 vec: str = "embedding", decimals: int = 6, watermark: str = "0 seconds") -> DataFrame:
    """STR5 / LLM2 / FIL11: the semantic cache over a request stream, one cache
    per ``block``, as the service works: a hit is answered from a live entry, a
    miss is stored. Entries are list state; a timer at each
    cache's oldest entry removes what has expired by event time, with or without
    requests. (``ttlDurationMs`` counts processing time, so replaying an hour's
    log in a minute would keep every entry; event-time timers expire it exactly.)

    The rows of one cache in one micro-batch and its live entries are held by a
    task; the source's admission limits bound the former. Rows without a time
    are left out; without a vector they miss."""
    _needs_rocksdb(requests)
    r = (requests.where(F.col(ts).isNotNull() & F.col(id_col).isNotNull())
         .select(F.col(id_col).cast("long").alias("request_id"), F.col(ts).cast("timestamp").alias("_at"), _us(ts).alias("us"), F.col(block).alias("block"),
                 F.coalesce(F.col(vec).cast("array<double>"), F.array().cast("array<double>")).alias("v"))
         .withWatermark("_at", watermark))
    processor = CacheProcessor(threshold, int(ttl_s * 1_000_000), decimals)
    return r.groupBy("block").transformWithStateInPandas(processor, CACHE_OUT, "Append", "EventTime")


def shared_cache(path: str, threshold: float = 0.92, ttl_s: int = 3600, id_col: str = "request_id", ts: str = "created_at",
                 vec: str = "embedding", decimals: int = 6) -> Callable[[DataFrame, int], None]:
    """STR5 / LLM2 / FIL11: one semantic cache that all callers share, over a
    request stream, as the service works. No key splits it, so each micro-batch
    is replayed by the whole cluster (:func:`cache_replay_sequential`) with the
    entries that live on from the batches before.

    Under ``path`` lie the ``answers`` and the state, ``entries``: for each
    batch those that its misses stored and the earlier ones that still live
    after its last request. A batch that is run again writes its own folders
    again. Rows without a time or a vector miss and store nothing."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = [id_col, ts, vec, "row"]
        asked = batch.withColumn("row", F.monotonically_increasing_id()).select(*cols)
        asked.write.mode("overwrite").parquet(f"{path}/asked/batch={batch_id}")
        asked = spark.read.schema(asked.schema).parquet(f"{path}/asked/batch={batch_id}")
        held = spark.read.schema(asked.schema).parquet(f"{path}/entries/batch={batch_id - 1}") if batch_id else None
        replay = cache_replay_sequential(asked, threshold, ttl_s, id_col, ts, vec, decimals, row_col="row", held=held, keep_row=True)
        replay.write.mode("overwrite").parquet(f"{path}/answers/batch={batch_id}")
        missed = spark.read.schema(replay.schema).parquet(f"{path}/answers/batch={batch_id}").where(~F.col("hit")).select("row")
        stored = asked.where(F.col(ts).isNotNull() & F.col(vec).isNotNull())
        last = stored.select(ts) if held is None else stored.select(ts).unionAll(held.select(ts))
        last_us = last.agg(F.max(_us(ts))).first()[0]
        entries = stored.join(missed, "row", "left_semi").select(*cols)
        entries = entries if held is None else entries.unionAll(held)
        if last_us is not None:
            entries = entries.where(_us(ts) + int(ttl_s * 1_000_000) > last_us)
        (entries.withColumn("row", -1 - F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/entries/batch={batch_id}"))

    return fn


# ---------------------------------------------------------------------------
# STR4: circuit breaker
# ---------------------------------------------------------------------------

BREAKER_OUT = "request_id long, model string, state_before string, skipped boolean, state_after string, recent_failures int, at_us long"


class BreakerProcessor(_Timed):
    """Per model: list state of recent failure times, value state (state,
    open_until) and a timer at ``open_until``."""

    def __init__(self, threshold: int, window_s: float, open_s: float, maxlen: int):
        self.settings = threshold, window_s, open_s, maxlen

    def init(self, handle) -> None:
        super().init(handle)
        self.failures = handle.getListState("failures", "t double")
        self.breaker = handle.getValueState("breaker", "state string, open_until double")

    def _load(self) -> Breaker:
        held = self.breaker.get() if self.breaker.exists() else None
        fails = [r[0] for r in self.failures.get()] if self.failures.exists() else []
        return Breaker(*self.settings, *((held[0], held[1]) if held else ("CLOSED", 0.0)), fails)

    def _save(self, b: Breaker) -> None:
        if b.failures:
            self.failures.put([(float(x),) for x in b.failures])
        else:  # the store keeps no empty lists
            self.failures.clear()
        self.breaker.update((b.state, float(b.open_until)))
        if b.state == "OPEN":
            self.timer_at(int(np.ceil(b.open_until * 1e6)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # three numbers a call are kept of each frame
        us, ids, failed = (np.concatenate(x) for x in zip(*((p["us"].to_numpy(), p["request_id"].to_numpy(), p["failed"].to_numpy()) for p in rows), strict=True))
        order = np.lexsort((ids, us))
        b = self._load()
        steps = [b.call(t, f) for t, f in zip((us[order] / 1e6).tolist(), failed[order].tolist(), strict=True)]
        self._save(b)
        yield pd.DataFrame({"request_id": ids[order], "model": key[0], "state_before": [s[0] for s in steps], "skipped": [s[1] for s in steps],
                            "state_after": [s[2] for s in steps], "recent_failures": np.array([s[3] for s in steps], dtype=np.int32), "at_us": us[order]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """An OPEN breaker whose time is up turns HALF_OPEN without a call."""
        b = self._load()
        if b.state != "OPEN" or b.open_until * 1000 > timerValues.getCurrentWatermarkInMs():
            return
        b.state = "HALF_OPEN"
        self._save(b)
        yield pd.DataFrame({"request_id": pd.array([None], dtype="Int64"), "model": [key[0]], "state_before": ["OPEN"], "skipped": [False],
                            "state_after": ["HALF_OPEN"], "recent_failures": np.array([len(b.failures)], dtype=np.int32), "at_us": [int(np.ceil(b.open_until * 1e6))]})


def stream_breaker(calls: DataFrame, threshold: int = 5, window_s: float = 60, open_s: float = 60, maxlen: int | None = None, key: str = "model",
                   ts: str = "created_at", watermark: str = "0 seconds") -> DataFrame:
    """STR4 / LLM4: breaker state per model. One row per call, as in the batch
    replay, and one with a null ``request_id`` where a timer at ``open_until``
    moves a silent model from OPEN to HALF_OPEN."""
    _needs_rocksdb(calls)
    c = (calls.where(F.col(ts).isNotNull())
         .select(F.col("request_id").cast("long").alias("request_id"), F.col(key).alias("model"), F.col(ts).cast("timestamp").alias("_at"), _us(ts).alias("us"),
                 F.coalesce(F.col("failed"), F.lit(False)).alias("failed")).withWatermark("_at", watermark))
    processor = BreakerProcessor(threshold, float(window_s), float(open_s), maxlen or threshold * 2)
    return c.groupBy("model").transformWithStateInPandas(processor, BREAKER_OUT, "Append", "EventTime")


def breaker_snapshot(rows: DataFrame) -> DataFrame:
    """AGG25: each model's latest state from the rows of :func:`stream_breaker`
    (of a call and a timer at one moment, the call)."""
    last = F.struct("at_us", F.col("request_id").isNotNull().alias("call"), "request_id")
    return rows.groupBy("model").agg(F.max_by(F.struct(F.col("state_after").alias("state"), "recent_failures"), last).alias("r")).select("model", "r.*")


# ---------------------------------------------------------------------------
# STR8: gauges that fall
# ---------------------------------------------------------------------------

COUNTERS = ["total", "hits", "misses", "aborted", "active_streams", "live_entries"]
GAUGES_OUT = "model string, tick_us long, " + ", ".join(f"{c} long" for c in COUNTERS)


class GaugeProcessor(_Timed):
    """Per model: the counters at the last tick, and map state of what changes
    at each later tick. A request adds to the first tick at or after it starts,
    its stream and cache entry leave at the first tick at or after they end, so
    the order of arrival does not matter."""

    def __init__(self, tick_us: int, ttl_us: int):
        self.tick_us, self.ttl_us = tick_us, ttl_us

    def init(self, handle) -> None:
        super().init(handle)
        kinds = ", ".join(f"{c} long" for c in COUNTERS)
        self.now = handle.getValueState("now", kinds)
        self.changes = handle.getMapState("changes", "tick long", kinds)

    def _changes(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        us, hit, aborted = pdf["us"].to_numpy(), pdf["cache_hit"].to_numpy(bool), pdf["aborted"].to_numpy(bool)
        stores = ~hit & ~aborted & ~pdf["failed"].to_numpy(bool)
        runs = pdf["lasts_us"].to_numpy() > 0
        one, none = np.ones(len(us), dtype=np.int64), np.zeros(len(us), dtype=np.int64)
        yield us, np.stack([one, hit, ~hit, aborted, runs, stores], axis=1).astype(np.int64)
        yield (us + pdf["lasts_us"].to_numpy())[runs], np.stack([none, none, none, none, -one, none], axis=1)[runs]
        yield (us + self.ttl_us)[stores], np.stack([none, none, none, none, none, -one], axis=1)[stores]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added: dict[int, np.ndarray] = {}
        for pdf in rows:
            for us, change in self._changes(pdf):
                ticks, at = np.unique(-(-us // self.tick_us), return_inverse=True)
                sums = np.zeros((len(ticks), len(COUNTERS)), dtype=np.int64)
                np.add.at(sums, at, change)
                for t, s in zip(ticks.tolist(), sums, strict=True):
                    added[t] = added[t] + s if t in added else s
        for t, s in added.items():
            held = self.changes.getValue((t,)) if self.changes.containsKey((t,)) else (0,) * len(COUNTERS)
            self.changes.updateValue((t,), tuple(int(x) + int(y) for x, y in zip(held, s, strict=True)))
        self.timer_at(min(added) * self.tick_us)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Counters at every tick up to the watermark at which one changes."""
        fired = timerValues.getCurrentWatermarkInMs()
        end = fired * 1000 // self.tick_us
        held = sorted((k[0], tuple(v)) for k, v in self.changes.iterator())
        now = np.array(self.now.get() if self.now.exists() else (0,) * len(COUNTERS), dtype=np.int64)
        out = []
        for tick, change in held:
            if tick <= end:
                now = now + np.array(change, dtype=np.int64)
                out.append((key[0], tick * self.tick_us, *now.tolist()))
                self.changes.removeKey((tick,))
        self.now.update(tuple(now.tolist()))
        self.timer_at(min((t * self.tick_us for t, _ in held if t > end), default=None), fired)
        if out:
            yield pd.DataFrame(out, columns=["model", "tick_us", *COUNTERS])


def stream_service_gauges(log: DataFrame, tick_s: int = 60, ttl_s: int = 3600, unit_us: int = 1000, ts: str = "created_at",
                          watermark: str = "0 seconds") -> DataFrame:
    """STR8 / AGG25: service counters per model at every tick of event time at
    which one changes: requests, hits, misses, aborted, running streams and live
    cache entries. The last two fall again when their time is over, by timers,
    without further requests. Equal to :func:`ragloom.operators.llmops.service_gauges`
    at the tick's time. ``unit_us``: microseconds of a unit of ``latency_ms``."""
    _needs_rocksdb(log)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    r = (log.where(F.col(ts).isNotNull())
         .select("model", F.col(ts).cast("timestamp").alias("_at"), _us(ts).alias("us"), flag("cache_hit"), flag("failed"), flag("aborted"),
                 (F.coalesce(F.col("latency_ms"), F.lit(0)) * unit_us).cast("long").alias("lasts_us")).withWatermark("_at", watermark))
    return r.groupBy("model").transformWithStateInPandas(GaugeProcessor(tick_s * 1_000_000, ttl_s * 1_000_000), GAUGES_OUT, "Append", "EventTime")


# ---------------------------------------------------------------------------
# STR10: span batches by count or timeout
# ---------------------------------------------------------------------------

BATCH_OUT = "client string, batch_no long, first_us long, spans long, names string, reason string"


class SpanProcessor(_Timed):
    """Per client: list state of the open batch, value state of its number."""

    def __init__(self, size: int, timeout_us: int):
        self.size, self.timeout_us = size, timeout_us

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", "us long, name string")
        self.number = handle.getValueState("number", "n long")

    def _flushed(self, key, batch: list[tuple[int, str]], number: int, reason: str) -> tuple:
        return key[0], number, batch[0][0], len(batch), ">".join(n for _, n in batch), reason

    def _save(self, batch: list[tuple[int, str]], number: int) -> None:
        if batch:
            self.open.put(batch)
            self.timer_at(batch[0][0] + self.timeout_us)
        else:
            self.open.clear()
        self.number.update((number,))

    def _load(self) -> tuple[list[tuple[int, str]], int]:
        batch = [(r[0], r[1]) for r in self.open.get()] if self.open.exists() else []
        return batch, self.number.get()[0] if self.number.exists() else 0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch, number = self._load()
        came = sorted((us, trace, i, name) for p in rows for us, trace, i, name in zip(*(p[c].tolist() for c in ("us", "trace_id", "span_id", "name")), strict=True))
        out = []
        for us, _, _, name in came:
            if batch and us >= batch[0][0] + self.timeout_us:
                out.append(self._flushed(key, batch, number, "timeout"))
                batch, number = [], number + 1
            batch.append((us, name))
            if len(batch) == self.size:
                out.append(self._flushed(key, batch, number, "size"))
                batch, number = [], number + 1
        self._save(batch, number)
        if out:
            yield pd.DataFrame(out, columns=["client", "batch_no", "first_us", "spans", "names", "reason"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, number = self._load()
        if not batch:
            return
        if _due_ms(batch[0][0] + self.timeout_us) > timerValues.getCurrentWatermarkInMs():
            self.timer_at(batch[0][0] + self.timeout_us, timerValues.getCurrentWatermarkInMs())  # the timer was for a batch that was full before
            return
        self._save([], number + 1)
        yield pd.DataFrame([self._flushed(key, batch, number, "timeout")], columns=["client", "batch_no", "first_us", "spans", "names", "reason"])


def stream_span_flushes(spans: DataFrame, client: str, size: int = 10, timeout_s: float = 2, ts: str = "start_ts", watermark: str = "0 seconds") -> DataFrame:
    """STR10: the client's batches of spans: flushed at ``size`` spans, or
    ``timeout_s`` after the first one, whichever comes first; a timer flushes a
    batch to which nothing is added."""
    _needs_rocksdb(spans)
    s = (spans.where(F.col(ts).isNotNull())
         .select(F.col(client).alias("client"), F.col(ts).cast("timestamp").alias("_at"), _us(ts).alias("us"), "trace_id", "span_id", "name")
         .withWatermark("_at", watermark))
    return s.groupBy("client").transformWithStateInPandas(SpanProcessor(size, int(timeout_s * 1_000_000)), BATCH_OUT, "Append", "EventTime")
