"""Table scans (SRC4, SRC10) and the stand-in mappings of the test tables.

Every loader is a lazy ``spark.read.parquet``; projections and filters added
later reach the scan through Catalyst (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: ``(vec_id, embedding array<float>, label)``."""
    return table(spark, sf_dir, "embeddings")


# ---------------------------------------------------------------------------
# D9 request log, mapped from ``events`` (one expression set, also written in
# SQL in the oracle so both engines see the same log).
# ---------------------------------------------------------------------------

# Tier names in key order and their tokens per window (D10).
TIER_ORDER = ["free", "pro", "enterprise"]
TIER_TOKENS = {"free": 5000, "pro": 20000, "enterprise": 100000}


def request_log(events: DataFrame) -> DataFrame:
    """SRC10: map ``events`` rows to the request-log schema of the cost tracker.

    Columns: request_id, created_at, api_key, tier, model, input_tokens,
    output_tokens, latency_ms, ttft_ms, cache_hit, fallback_used, failed,
    aborted, k.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    key_no = F.col("user_id") % 12
    tier = (
        F.when(key_no % 3 == 0, F.lit("free"))
        .when(key_no % 3 == 1, F.lit("pro"))
        .otherwise(F.lit("enterprise"))
    )
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.concat(F.lit("key-"), key_no.cast("string")).alias("api_key"),
        tier.alias("tier"),
        F.concat(F.lit("model-"), (F.col("user_id") % 5).cast("string")).alias("model"),
        (k * 40).cast("bigint").alias("input_tokens"),
        (F.floor("value").cast("bigint") * 3).alias("output_tokens"),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"),
        F.floor(F.col("value") * 2).cast("bigint").alias("ttft_ms"),
        (k % 4 == 0).alias("cache_hit"),
        (k % 10 == 0).alias("fallback_used"),
        (F.col("event_type") == "error").alias("failed"),
        (k % 25 == 7).alias("aborted"),
        k.alias("k"),
        F.col("user_id"),
    )


REQUEST_LOG_SQL = """
SELECT event_id AS request_id,
       ts AS created_at,
       'key-' || (user_id % 12) AS api_key,
       CASE (user_id % 12) % 3 WHEN 0 THEN 'free' WHEN 1 THEN 'pro' ELSE 'enterprise' END AS tier,
       'model-' || (user_id % 5) AS model,
       CAST(json_extract(props, '$.k') AS INTEGER) * 40 AS input_tokens,
       CAST(floor(value) AS BIGINT) * 3 AS output_tokens,
       CAST(floor(value * 10) AS BIGINT) AS latency_ms,
       CAST(floor(value * 2) AS BIGINT) AS ttft_ms,
       CAST(json_extract(props, '$.k') AS INTEGER) % 4 = 0 AS cache_hit,
       CAST(json_extract(props, '$.k') AS INTEGER) % 10 = 0 AS fallback_used,
       event_type = 'error' AS failed,
       CAST(json_extract(props, '$.k') AS INTEGER) % 25 = 7 AS aborted,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       user_id
FROM events
"""


def tiers(spark: SparkSession, n_keys: int = 12) -> DataFrame:
    """D10 tier dimension for the mapped keys (small, broadcast)."""
    rows = []
    for i in range(n_keys):
        t = TIER_ORDER[i % 3]
        rows.append((f"key-{i}", t, TIER_TOKENS[t]))
    return spark.createDataFrame(rows, "api_key string, tier string, tokens_per_min bigint")


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
