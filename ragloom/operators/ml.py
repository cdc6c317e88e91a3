"""Tabular ML with Spark ML (ML4-ML14, AGG14, AGG26): preprocessing pipeline,
three classifiers, metrics on validation and test splits, experiment table,
best-run choice, a model registry with aliases and promotion, batch scoring,
feature importances and k-means segmentation.

Training is Spark ML (distributed); metrics are DataFrame aggregations.
Notes on parity with the scikit-learn source: ``StandardScaler`` divides by
n-1 (sklearn: n); logistic regression's ``C`` maps to ``regParam = 1/(C*n)``;
tree learners bin continuous features.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored
from .evals import binary_metrics, feature_ratio, rule_score


def preprocessor(numeric: Sequence[str], categorical: Sequence[str] = ()) -> list:
    """ML4: median imputation and scaling of numeric columns, one-hot of
    categorical columns with unknown values kept in their own slot."""
    numeric, categorical = list(numeric), list(categorical)
    imp = [f"{c}__imp" for c in numeric]
    stages = [Imputer(strategy="median", relativeError=0.0, inputCols=numeric, outputCols=imp)]
    stages.append(VectorAssembler(inputCols=imp, outputCol="num_vec"))
    stages.append(StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True))
    cat_out = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", handleInvalid="keep"))
        cat_out.append(f"{c}__oh")
    stages.append(VectorAssembler(inputCols=["num_scaled", *cat_out], outputCol="features"))
    return stages


@dataclass
class ModelConfig:
    name: str
    params: dict = field(default_factory=dict)


# The three learners and their settings (ML6-ML8).
DEFAULT_CONFIGS = [
    ModelConfig("logistic_regression", {"C": 1.0, "maxIter": 1000}),
    ModelConfig("random_forest", {"numTrees": 200, "maxDepth": 8}),
    ModelConfig("gradient_boosting", {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}),
]


def _learner(cfg: ModelConfig, n_train: int, label: str, seed: int):
    p = cfg.params
    if cfg.name == "logistic_regression":
        return LogisticRegression(labelCol=label, featuresCol="features", maxIter=int(p.get("maxIter", 100)),
                                  regParam=1.0 / (float(p.get("C", 1.0)) * max(n_train, 1)), elasticNetParam=0.0)
    if cfg.name == "random_forest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=int(p.get("numTrees", 50)),
                                      maxDepth=int(p.get("maxDepth", 5)), seed=seed)
    if cfg.name == "gradient_boosting":
        return GBTClassifier(labelCol=label, featuresCol="features", maxIter=int(p.get("maxIter", 20)),
                             maxDepth=int(p.get("maxDepth", 3)), stepSize=float(p.get("stepSize", 0.1)), seed=seed)
    raise ValueError(cfg.name)


def _fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """The fitted pipeline without its learner's training summary. A summary
    holds the session, and every task that scores would be sent it; a session
    that has observed a write cannot be sent. What is stored and read back is
    the learner alone, without its summary."""
    model = pipeline.fit(train)
    last = model.stages[-1]
    if not getattr(last, "hasSummary", False):
        return model
    path = scratch_path(train.sparkSession, f"learner-{uuid.uuid4().hex}")
    last.save(path)
    return PipelineModel(stages=[*model.stages[:-1], type(last).load(path)])


def _ml_layout(df: DataFrame) -> DataFrame:
    """Iterative learners aggregate over every partition per iteration: merge
    tiny partitions (no shuffle) down to about twice the cluster's cores.
    ``coalesce`` leaves an input with fewer partitions as it is."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def run_experiments(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                    configs: Sequence[ModelConfig] = DEFAULT_CONFIGS, split_col: str = "split", seed: int = 42):
    """ML5-ML8 + ML12: fit every config on ``split == 'train'`` and score val
    and test. Returns ``(runs, models)``: ``runs`` has one row per run and
    split with metrics; ``models`` maps run id -> fitted ``PipelineModel``."""
    spark = df.sparkSession
    train = _ml_layout(df.filter(F.col(split_col) == "train")).persist()
    n_train = train.count()
    rows = []
    models = {}
    for pos, cfg in enumerate(configs):
        run_id = uuid.uuid5(uuid.NAMESPACE_OID, f"{cfg.name}-{sorted(cfg.params.items())}-{seed}").hex[:12]
        pipe = Pipeline(stages=preprocessor(numeric, categorical) + [_learner(cfg, n_train, label, seed)])
        t0 = time.time()
        model = _fit(pipe, train)
        fit_s = time.time() - t0
        models[run_id] = model
        pred = model.transform(df.filter(F.col(split_col).isin("val", "test")))
        m = binary_metrics(pred, label=label, prediction="prediction", by=[split_col]).collect()  # two rows
        for r in m:
            rows.append((run_id, pos, cfg.name, str(sorted(cfg.params.items())), r[split_col], int(r["n"]),
                         float(r["accuracy"]), float(r["precision"]), float(r["recall"]), float(r["f1"]), round(fit_s, 3)))
    train.unpersist()
    runs = spark.createDataFrame(rows, "run_id string, pos int, model string, params string, split string, n long, "
                                       "accuracy double, precision double, recall double, f1 double, fit_seconds double")
    return runs, models


def best_run(runs: DataFrame, split: str | None = "test", metric: str = "f1", by: Sequence[str] = ()) -> DataFrame:
    """AGG26 / S24: the run with the highest metric on ``split`` (per ``by``
    group), first run (lowest position) on ties."""
    r = runs.filter(F.col("split") == split) if split is not None else runs
    best = F.max_by(F.struct("run_id", "model", metric), F.struct(F.col(metric), -F.col("pos"))).alias("b")
    return r.groupBy(*by).agg(best).select(*by, "b.*")


def cross_validate(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                   config: ModelConfig | None = None, fold_col: str = "fold", seed: int = 42) -> DataFrame:
    """ML9 (ML5, ML6 by default): per fold, fit the pipeline on the other folds and score this one:
    ``(fold, n, accuracy, precision, recall, f1)``."""
    config = config or DEFAULT_CONFIGS[0]
    df = _ml_layout(df).persist()
    out = None
    for fold in sorted(r[0] for r in df.select(fold_col).distinct().collect()):  # a handful of folds
        train = df.filter(F.col(fold_col) != fold)
        model = _fit(Pipeline(stages=preprocessor(numeric, categorical) + [_learner(config, train.count(), label, seed)]), train)
        one = binary_metrics(model.transform(df.filter(F.col(fold_col) == fold)), label, "prediction", by=[fold_col])
        one = stored(one, "fold-metrics")  # one row
        out = one if out is None else out.unionByName(one)
    df.unpersist()
    return out


def preprocess_statistics(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), split_col: str = "split") -> DataFrame:
    """ML4 / ML5: what the preprocessing learns from the train split, as rows
    ``(feature, statistic, value)``: median, mean and scale of each numeric
    column, width of each one-hot block (unknown values have a slot)."""
    spark = df.sparkSession
    fitted = Pipeline(stages=preprocessor(numeric, categorical)).fit(df.filter(F.col(split_col) == "train"))
    imputer, scaler = fitted.stages[0], fitted.stages[2]
    medians = imputer.surrogateDF.first()
    rows = []
    for i, c in enumerate(numeric):
        rows += [(c, "median", float(medians[c])), (c, "mean", float(scaler.mean[i])), (c, "scale", float(scaler.std[i]))]
    encoders = [s for s in fitted.stages if hasattr(s, "categorySizes")]
    rows += [(c, "width", float(e.categorySizes[0])) for c, e in zip(categorical, encoders, strict=True)]
    return spark.createDataFrame([(f, s, round(v, 6)) for f, s, v in rows], "feature string, statistic string, value double")


def feature_importances(model: PipelineModel, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """ML10: importances of a tree model's input features, ranked."""
    last = model.stages[-1]
    imp = getattr(last, "featureImportances", None)
    if imp is None:
        coef = getattr(last, "coefficients", None)
        vals = [abs(float(x)) for x in coef] if coef is not None else []
    else:
        vals = [float(x) for x in imp.toArray()]
    names = list(names) + [f"f{i}" for i in range(len(names), len(vals))]
    rows = sorted(zip(names[:len(vals)], vals), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(n, round(v, 6), i + 1) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def score(model: PipelineModel, df: DataFrame, positive: str = "approved", negative: str = "rejected") -> DataFrame:
    """ML11: batch scoring with a text label and the positive-class
    probability rounded to 4."""
    p = model.transform(df)
    prob = F.round(vector_to_array(F.col("probability"))[1], 4)
    return p.withColumn("decision", F.when(F.col("prediction") == 1, F.lit(positive)).otherwise(F.lit(negative))).withColumn(
        "probability_positive", prob)


# ---------------------------------------------------------------------------
# ML13 registry: versions and aliases as tables
# ---------------------------------------------------------------------------


def register_runs(runs: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """ML13: add runs ``(name, run_id, f1, created)`` to the models table: within a
    name, versions go on from the highest one, by creation time."""
    w = Window.partitionBy("name").orderBy("created", "run_id")
    new = runs.select("name", F.row_number().over(w).alias("version"), "run_id", "f1", "created")
    if models is None:
        return new
    last = models.groupBy("name").agg(F.max("version").alias("_last"))
    new = new.join(last, "name", "left").withColumn("version", F.col("version") + F.coalesce("_last", F.lit(0))).drop("_last")
    return models.unionByName(new)


def set_alias(aliases: DataFrame | None, new: DataFrame) -> DataFrame:
    """Alias upsert of rows ``(name, alias, version)``: one version per name and
    alias."""
    new = new.select("name", "alias", F.col("version").cast("int").alias("version"))
    return new if aliases is None else aliases.join(new.select("name", "alias"), ["name", "alias"], "left_anti").unionByName(new)


def promote(models: DataFrame, aliases: DataFrame, src: str = "staging", dst: str = "production") -> DataFrame:
    """For every name, move ``dst`` to the ``src`` version iff its F1 is not
    lower than that of the current ``dst`` version (or there is none)."""
    scored = aliases.join(models.select("name", "version", "f1"), ["name", "version"])
    cur = scored.groupBy("name").agg(
        *[F.max(F.when(F.col("alias") == a, F.struct("f1", "version"))).alias(n) for n, a in (("s", src), ("d", dst))])
    moved = cur.filter(F.col("s").isNotNull() & (F.col("d").isNull() | (F.col("s.f1") >= F.col("d.f1"))))
    return set_alias(aliases, moved.select("name", F.lit(dst).alias("alias"), F.col("s.version").alias("version")))


def versions_by_alias(models: DataFrame, aliases: DataFrame) -> DataFrame:
    """JON13: every version with its aliases ('—' when none), versions in
    numeric order."""
    a = aliases.groupBy("name", "version").agg(F.array_join(F.sort_array(F.collect_list("alias")), ", ").alias("aliases"))
    return models.join(a, ["name", "version"], "left").fillna("—", ["aliases"]).orderBy("name", "version")


# ---------------------------------------------------------------------------
# ML14 / AGG14 k-means segmentation
# ---------------------------------------------------------------------------


def kmeans_segments(df: DataFrame, features: Sequence[str], k: int = 3, restarts: int = 10, seed: int = 42,
                    decimals: int = 4) -> tuple[DataFrame, DataFrame]:
    """ML14: standardised features, k-means with several seeds, the fit with
    the lowest training cost kept; clusters renumbered by ascending mean of the
    first feature. Returns ``(assignments, profile)`` (AGG14)."""
    feats = list(features)
    df = stored(df, "segments")  # its joins end here: a merged task would hold those of all its parts
    prep = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]).fit(df)
    x = prep.transform(df)
    points = _ml_layout(x.select("features")).persist()
    best = None
    for r in range(restarts):
        m = KMeans(k=k, seed=seed + r, featuresCol="features", predictionCol="cluster").fit(points)
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    points.unpersist()
    assigned = best[1].transform(x).drop("raw", "features")
    order = assigned.groupBy("cluster").agg(F.avg(feats[0]).alias("_m"))
    order = order.select("cluster", (F.row_number().over(Window.orderBy("_m", "cluster")) - 1).alias("segment"))
    assigned = assigned.join(F.broadcast(order), "cluster").drop("cluster")
    prof = assigned.groupBy("segment").agg(F.count(F.lit(1)).alias("size"),
                                           *[F.round(F.avg(c), decimals).alias(f"mean_{c}") for c in feats])
    return assigned, prof.withColumn("training_cost", F.lit(round(float(best[0]), 4)))


# Terms in months, Poisson(0.5) cumulative probabilities.
CREDIT_TERMS = [6, 12, 24, 36, 48, 60]
POISSON_HALF = [0.60653066, 0.90979599, 0.98561232, 0.99824838, 0.99982788, 0.99998584]


def credit_table(draws: DataFrame, noise: float = 0.08) -> DataFrame:
    """ML1: the credit table from uniform draws ``u1 .. u8`` in (0, 1) per row
    (other columns stay): age 20 to 65; income normal (35000, 15000) within
    5000 and 120000, whole; delinquencies Poisson(0.5) up to 10; term; amount of
    1 to 8 incomes, whole; debt to income (FUN19); approved when the weighted
    rule (FIL13) reaches 3.5, flipped with probability ``noise``."""
    normal = F.sqrt(-2 * F.log("u2")) * F.cos(2 * F.lit(3.141592653589793) * F.col("u3"))
    delinquencies = F.lit(0)
    for p in POISSON_HALF:
        delinquencies = delinquencies + (F.col("u4") >= p).cast("int")
    terms = F.array(*[F.lit(t) for t in CREDIT_TERMS])
    d = draws.withColumns({
        "age": (F.floor(F.col("u1") * 46) + 20).cast("int"),
        "monthly_income": F.floor(F.greatest(F.lit(5000.0), F.least(F.lit(120000.0), 35000 + 15000 * normal))).cast("bigint"),
        "num_delinquencies": F.least(delinquencies, F.lit(10)),
        "credit_term_months": F.element_at(terms, (F.floor(F.col("u5") * 6) + 1).cast("int"))})
    d = d.withColumn("credit_amount", F.floor(F.col("monthly_income") * (1 + 7 * F.col("u6"))).cast("bigint"))
    d = d.withColumn("debt_to_income", feature_ratio(F.col("credit_amount"), F.col("monthly_income"), F.col("credit_term_months")))
    score = rule_score([(F.col("monthly_income") > 20000, 1.5), (F.col("num_delinquencies") == 0, 2.0), (F.col("debt_to_income") < 0.3, 1.5),
                        (F.col("age") > 25, 0.5), (F.col("credit_term_months") <= 36, 0.5)])
    label = (score >= 3.5).cast("int")
    return d.withColumn("approved", F.when(F.col("u7") < noise, 1 - label).otherwise(label)).drop(*[f"u{i}" for i in range(1, 9)])


def synthetic_credit_table(spark: SparkSession, n: int, seed: int = 42, noise: float = 0.08) -> DataFrame:
    """ML1: ``n`` rows of :func:`credit_table` with random draws."""
    return credit_table(spark.range(n).select(*[(F.rand(seed + i) * 0.999999 + 5e-7).alias(f"u{i}") for i in range(1, 9)]), noise)
