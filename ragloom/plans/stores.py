"""Registered queries over stored points, stored models, sketches and table
functions."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import evals as E
from ..operators import extractors as X
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import retrieval as R
from ..operators.stores import ModelStore, PointStore, score_by_alias
from ..session import scratch_path
from ..sources.tables import table
from ..streaming import jobs as S
from .evals import CREDIT_NUMERIC, SEED, credit_table
from .files import SQL_PAGE_FILES, page_files
from .llmops import SQL_LOG, log
from .more import SQL_CHUNKS, fixed_chunk_points
from .registry import register
from .retrieval import SQL_BM25, TOKEN_RE, bm25_ranked, lexical_inputs


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stores/{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# SNK10
# ---------------------------------------------------------------------------


@register("chunk_upsert", sql=f"""WITH {SQL_CHUNKS}
SELECT 'upsert' AS step, CASE WHEN doc_id % 3 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS version, count(*) AS points,
       count(DISTINCT point_id) AS distinct_points FROM pt GROUP BY 1, 2
UNION ALL SELECT 'recreate', 9, count(*), count(DISTINCT point_id) FROM pt WHERE doc_id % 7 = 0""", ops="SNK10")
def chunk_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """All points stored; some documents' points sent again, twice, replacing
    the old ones in place; then the store recreated from fewer."""
    store = PointStore(spark, _fresh(spark, "points"))
    points = fixed_chunk_points(spark, sf).select("point_id", "doc_id")
    for version, mod in ((1, 1), (2, 7), (3, 3)):
        store.upsert(points.filter(F.col("doc_id") % mod == 0).withColumn("version", F.lit(version)))
    counts = [F.count(F.lit(1)).alias("points"), F.count_distinct("point_id").alias("distinct_points")]
    upserted = spark.createDataFrame(store.read().groupBy("version").agg(*counts).collect(), "version int, points bigint, distinct_points bigint")  # three rows
    store.recreate(points.filter(F.col("doc_id") % 7 == 0).withColumn("version", F.lit(9)))
    recreated = store.read().groupBy("version").agg(*counts)
    return upserted.select(F.lit("upsert").alias("step"), "*").unionByName(recreated.select(F.lit("recreate").alias("step"), "*"))


# ---------------------------------------------------------------------------
# AGG5 / AGG4 by sketches
# ---------------------------------------------------------------------------

RANK_ERROR = 0.015


@register("latency_sketches", sql=f"""WITH {SQL_LOG},
d AS (SELECT 'day' AS level, strftime(created_at, '%Y-%m-%d') AS name, latency_ms FROM lg UNION ALL SELECT 'model', model, latency_ms FROM lg)
SELECT level, name, count(*) AS n, true AS p50_ok, true AS p95_ok, true AS p99_ok FROM d GROUP BY level, name""", ops="AGG5")
def latency_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """One sketch per model and hour, merged to days and to models without the
    rows; the share of rows below each answer lies within the rank error."""
    lg = log(spark, sf).select("model", "created_at", F.col("latency_ms").cast("double").alias("v"))
    lg = lg.withColumn("day", F.date_format("created_at", "yyyy-MM-dd"))
    hours = M.quantile_sketch(lg.withColumn("hour", F.date_trunc("hour", "created_at")), "v", ["model", "day", "hour"])
    parts = []
    for level, key in (("day", "day"), ("model", "model")):
        merged = M.sketch_summary(M.merge_sketches(hours, [key]), [key])
        rows = lg.select(key, "v").join(merged, key)
        ok = []
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            below, upto = F.avg((F.col("v") < F.col(name)).cast("double")), F.avg((F.col("v") <= F.col(name)).cast("double"))
            # an answer covers its own rows; a group of few rows has steps of 1 / n
            ok.append(((below - RANK_ERROR - 1 / F.count(F.lit(1)) <= q) & (upto + RANK_ERROR + 1 / F.count(F.lit(1)) >= q)).alias(f"{name}_ok"))
        parts.append(rows.groupBy(key, "n").agg(*ok).select(F.lit(level).alias("level"), F.col(key).alias("name"), F.col("n").cast("bigint").alias("n"), "p50_ok", "p95_ok", "p99_ok"))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# UDF6 / TXT13
# ---------------------------------------------------------------------------


def mixed_files(pages: DataFrame) -> DataFrame:
    """Stand-in files of three types: pages as text, page urls as JSON lists
    (every fifth cut off), and a type without an extractor."""
    kind = F.when(F.col("page_id") % 3 == 0, "txt").when(F.col("page_id") % 3 == 1, "json").otherwise("bin")
    record = F.to_json(F.array(F.struct(F.col("url"), F.col("page_id").alias("id")), F.struct(F.lower("url").alias("url"), F.lit(None).cast("bigint").alias("id"))))  # a null field is left out
    cut = F.when(F.col("page_id") % 5 == 0, F.substring(record, 1, 12)).otherwise(record)
    body = F.when(kind == "txt", F.replace(F.col("html"), F.lit("<br>"), F.lit("\n"))).otherwise(cut)
    return pages.select("page_id", kind.alias("kind"), F.encode(body, "UTF-8").alias("content"))


@register("extracted_rows", sql="""
WITH lines AS (SELECT page_id, unnest(string_split(replace(html, '<br>', chr(10)), chr(10))) AS l FROM pages WHERE page_id % 3 = 0)
SELECT page_id, 'txt' AS kind, 'line' AS field, CAST(NULL AS VARCHAR) AS error, count(*) AS n, CAST(sum(length(trim(l, ' ' || chr(9) || chr(13)))) AS BIGINT) AS chars
FROM lines WHERE trim(l, ' ' || chr(9) || chr(13)) <> '' GROUP BY page_id
UNION ALL SELECT page_id, 'json', 'url', NULL, 2, CAST(length(url) + length(lower(url)) AS BIGINT) FROM pages WHERE page_id % 3 = 1 AND page_id % 5 <> 0
UNION ALL SELECT page_id, 'json', 'id', NULL, 1, CAST(length(CAST(page_id AS VARCHAR)) AS BIGINT) FROM pages WHERE page_id % 3 = 1 AND page_id % 5 <> 0
UNION ALL SELECT page_id, 'json', NULL, 'JSONDecodeError', 1, NULL FROM pages WHERE page_id % 3 = 1 AND page_id % 5 = 0
UNION ALL SELECT page_id, 'bin', NULL, 'no extractor for bin', 1, NULL FROM pages WHERE page_id % 3 = 2""", ops="UDF6 TXT13 TXT4")
def extracted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """TXT4: files to rows by their type's extractor; a broken file and a type
    without an extractor become error rows."""
    rows = X.extract_rows(spark, mixed_files(table(spark, sf, "pages")))
    return rows.groupBy("page_id", "kind", "field", "error").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).cast("bigint").alias("chars"))


@register("arrival_rows_stream", sql=f"""WITH {SQL_PAGE_FILES},
lines AS (SELECT folder, unnest(string_split(html, chr(10))) AS l FROM f)
SELECT CAST(folder AS BIGINT) AS folder, count(*) AS n, CAST(sum(length(trim(l, ' ' || chr(9) || chr(13)))) AS BIGINT) AS chars
FROM lines WHERE trim(l, ' ' || chr(9) || chr(13)) <> '' GROUP BY folder""", ops="TXT13 UDF6 STR7 SRC11")
def arrival_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving files to rows on the stream, by the extractor of their suffix."""
    arrived = S.file_arrivals(spark, page_files(spark, sf), "*.txt").select("path", F.regexp_extract("path", r"\.(\w+)$", 1).alias("kind"), "content")
    done = spark.read.parquet(S.run_to_table(X.extract_rows(spark, arrived), "arrival-rows"))
    return done.groupBy(F.regexp_extract("path", r"folder=(\d+)/", 1).cast("bigint").alias("folder")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).cast("bigint").alias("chars"))


# ---------------------------------------------------------------------------
# ML13 / ML11: stored models; ML6-ML8 / ML14 against plain columns
# ---------------------------------------------------------------------------


@register("stored_model_scores", sql="""
SELECT m.name, m.alias, count(*) AS n, count(*) AS equal_scores, CAST(0 AS BIGINT) AS far_from_formula
FROM customer, (VALUES ('credit', 'production'), ('credit', 'first')) m(name, alias) GROUP BY ALL""", ops="ML13 ML11 JON13 ML6")
def stored_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Two logistic models (ML6) stored as versions, one promoted to production;
    the whole credit table scored by name and alias. The scores are those from
    before saving, and those of the stored coefficients written out as columns."""
    df = E.stratified_split(credit_table(spark, sf), "approved", "c_custkey", seed=SEED)
    numeric = CREDIT_NUMERIC
    configs = [ML.ModelConfig("logistic_regression", {"C": c, "maxIter": 50}) for c in (0.001, 1.0)]
    runs, models = ML.run_experiments(df, "approved", numeric, ["c_mktsegment"], configs=configs)
    store = ModelStore(spark, _fresh(spark, "models"))
    versions = {run: i + 1 for i, run in enumerate(models)}
    for run, version in versions.items():
        store.save("credit", version, models[run])
    best = runs.filter(F.col("split") == "test").orderBy(F.col("f1").desc(), "pos").first()["run_id"]
    rows = [("credit", "production", versions[best]), ("credit", "first", 1)]
    aliases = ML.set_alias(None, spark.createDataFrame(rows, "name string, alias string, version int"))
    by_version = {v: models[run] for run, v in versions.items()}
    out = []
    for name, alias, version in rows:
        now = score_by_alias(store, aliases, name, alias, df)
        was = ML.score(by_version[version], df).select("c_custkey", F.col("probability_positive").alias("was"))
        loaded = store.load(aliases, name, alias).stages[-1]
        z = F.lit(float(loaded.intercept))
        x = vector_to_array(F.col("features"))
        z = z + F.aggregate(F.zip_with(x, F.array(*[F.lit(float(w)) for w in loaded.coefficients]), lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a)
        far = F.abs(vector_to_array(F.col("probability"))[1] - 1 / (1 + F.exp(-z))) > 1e-9
        out.append(now.select("c_custkey", F.col("probability_positive").alias("p"), far.cast("bigint").alias("far")).join(was, "c_custkey").agg(
            F.lit(name).alias("name"), F.lit(alias).alias("alias"), F.count(F.lit(1)).alias("n"),
            F.sum((F.col("p") == F.col("was")).cast("bigint")).alias("equal_scores"), F.sum("far").alias("far_from_formula")))
    return out[0].unionByName(out[1])


@register("kmeans_checks", sql="""
SELECT count(*) AS n, CAST(3 AS BIGINT) AS segments, CAST(0 AS BIGINT) AS nearer_elsewhere, true AS order_by_mean FROM customer""", ops="ML14 AGG14")
def kmeans_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer belongs to the segment whose centre (mean of the scaled
    features) is nearest, and segments are numbered by their first feature's
    mean: found with plain columns from the assignment alone."""
    feats = ["c_acctbal", "n_orders", "total_spend"]
    rows, _ = ML.kmeans_segments(credit_table(spark, sf).fillna(0.0, ["total_spend", "avg_order"]), feats, k=3, restarts=10, seed=SEED)
    whole = rows.agg(*[f(c).alias(f"{n}_{c}") for c in feats for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    scaled = rows.select("segment", F.col(feats[0]).alias("first"),
                         F.array(*[(F.col(c) - F.lit(whole[f"m_{c}"])) / F.lit(whole[f"s_{c}"]) for c in feats]).alias("x"))
    centres = scaled.groupBy("segment").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(feats))]).alias("c"), F.avg("first").alias("mean"))
    centres = sorted(centres.collect())  # three centres
    far = lambda c: F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, a: s + a)
    d = scaled.withColumn("far", F.array(*[far(F.array(*[F.lit(float(v)) for v in r["c"]])) for r in centres]))
    own = F.element_at("far", F.col("segment") + 1)
    ordered = all(a["mean"] <= b["mean"] for a, b in zip(centres, centres[1:], strict=False))
    # Lloyd's rounds end when the centres move by less than a tolerance
    return d.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("segment").alias("segments"),
                 F.sum((F.array_min("far") < own * F.lit(0.999) - 1e-3).cast("bigint")).alias("nearer_elsewhere"), F.lit(ordered).alias("order_by_mean"))


@register("tree_model_checks", sql="""
SELECT m.model, count(*) AS n, CAST(0 AS BIGINT) AS far_from_votes, m.trees AS trees, CAST(1.0 AS DOUBLE) AS importance_total
FROM customer, (VALUES ('random_forest', CAST(20 AS BIGINT)), ('gradient_boosting', CAST(10 AS BIGINT))) m(model, trees) GROUP BY m.model, m.trees""",
          ops="ML7 ML8 ML10 ML5")
def tree_model_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's (ML7) and the boosted trees' (ML8) probabilities against the
    answers of their single trees put together with plain columns, and their
    ranked importances' total (ML10)."""
    df = E.stratified_split(credit_table(spark, sf), "approved", "c_custkey", seed=SEED)
    configs = [ML.ModelConfig("random_forest", {"numTrees": 20, "maxDepth": 4}), ML.ModelConfig("gradient_boosting", {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1})]
    runs, models = ML.run_experiments(df, "approved", CREDIT_NUMERIC, ["c_mktsegment"], configs=configs)
    out = []
    for cfg, model in zip(configs, models.values(), strict=True):
        last = model.stages[-1]
        rows = model.transform(df)
        if cfg.name == "random_forest":
            rows = rows.withColumn("_sum", F.array(F.lit(0.0), F.lit(0.0)))
            for i, tree in enumerate(last.trees):
                tree.setFeaturesCol("features").setPredictionCol(f"_t{i}").setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}")
                rows = tree.transform(rows).withColumn("_sum", F.zip_with("_sum", vector_to_array(F.col(f"_p{i}")), lambda a, b: a + b)).drop(f"_t{i}", f"_p{i}", f"_r{i}")
            probability = F.col("_sum")[1] / len(last.trees)
        else:
            rows = rows.withColumn("_sum", F.lit(0.0))
            for i, (tree, weight) in enumerate(zip(last.trees, last.treeWeights, strict=True)):
                tree.setFeaturesCol("features").setPredictionCol(f"_t{i}")
                rows = tree.transform(rows).withColumn("_sum", F.col("_sum") + F.lit(float(weight)) * F.col(f"_t{i}")).drop(f"_t{i}")
            probability = 1 / (1 + F.exp(-2 * F.col("_sum")))
        total = ML.feature_importances(model, CREDIT_NUMERIC, spark).agg(F.sum("importance")).first()[0]
        far = F.abs(vector_to_array(F.col("probability"))[1] - probability) > 1e-9
        out.append(rows.agg(F.lit(cfg.name).alias("model"), F.count(F.lit(1)).alias("n"), F.sum(far.cast("bigint")).alias("far_from_votes"),
                            F.lit(len(last.trees)).cast("bigint").alias("trees"), F.lit(round(float(total), 3)).alias("importance_total")))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------------------
# UDF3
# ---------------------------------------------------------------------------


@register("rerank_model_scorer", sql=f"""WITH {SQL_BM25},
pairs AS (
  SELECT r.qid, r.did, r.rank AS first_rank, list_distinct(regexp_extract_all(lower(b.text), '{TOKEN_RE}')) AS qt,
         list_distinct(regexp_extract_all(lower(d.text), '{TOKEN_RE}')) AS dt
  FROM bm25_ranked r JOIN benchmark b ON b.item_id = r.qid JOIN documents d ON d.doc_id = r.did),
s AS (
  SELECT qid, did, first_rank,
         round(CASE WHEN len(qt) > 0 THEN coalesce(list_sum(list_transform(list_intersect(qt, dt), lambda w: power(length(w), 1.5))), 0)
                                          / list_sum(list_transform(qt, lambda w: power(length(w), 1.5))) ELSE 0.0 END, 6) AS score FROM pairs)
SELECT qid, did, first_rank, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_rank, did) AS INTEGER) AS rank
FROM s QUALIFY rank <= 10""", ops="UDF3 RET5 JON4")
def rerank_model_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred of BM25 re-sorted by a batch model scorer."""
    docs, items = lexical_inputs(spark, sf)
    bm, _ = bm25_ranked(spark, sf, k=100)
    return R.rerank(bm, items, docs, top_k=10, scorer=R.model_scorer('{"power": 1.5}'))
