"""Registered retrieval queries over ``embeddings``, ``documents`` and ``benchmark``.

Dense task (known-item): every vector whose id is divisible by 50 is a query
after seeded noise on all its components (a degraded copy); its relevant
document is the vector itself; the corpus is the whole table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import retrieval as R
from ..operators.common import stored
from ..session import scratch_path
from ..sources.tables import embeddings, table
from .registry import register

K = 10
QUERY_EVERY = 50  # the stated query set: ids divisible by this
NOISE = 0.5


def noisy(vec_id, vec):
    """Every component plus a fixed pseudo-random amount within ``NOISE``
    (integer arithmetic on id and position, the same in SQL)."""
    n = lambda i: ((vec_id * 48271 + i * 16807 + vec_id * i * 69621) % 2001 - 1000).cast("double") / 1000.0
    return F.transform(vec, lambda x, i: x.cast("double") + F.lit(NOISE) * n(i.cast("bigint")))


SQL_NOISY = (f"list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + {NOISE} * CAST((vec_id * 48271 + (i - 1) * 16807 "
             "+ vec_id * (i - 1) * 69621) % 2001 - 1000 AS DOUBLE) / 1000.0)")


def query_vectors(e: DataFrame) -> DataFrame:
    return e.select(F.col("vec_id").alias("qid"), noisy(F.col("vec_id"), F.col("embedding")).alias("embedding"))


def dense_queries(spark: SparkSession, sf: str) -> DataFrame:
    return query_vectors(embeddings(spark, sf).filter(F.col("vec_id") % QUERY_EVERY == 0))


def dense_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings(spark, sf).select(F.col("vec_id").alias("did"), "embedding")


def dense_qrels(spark: SparkSession, sf: str) -> DataFrame:
    q = embeddings(spark, sf).filter(F.col("vec_id") % QUERY_EVERY == 0)
    return q.select(F.col("vec_id").alias("qid"), F.col("vec_id").alias("did"))


# -- SQL fragments (DuckDB) --------------------------------------------------

SQL_DENSE_SCORES = f"""
q AS (SELECT vec_id AS qid, {SQL_NOISY} AS v FROM embeddings WHERE vec_id % {QUERY_EVERY} = 0),
d AS (SELECT vec_id AS did, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (
  SELECT q.qid, d.did,
         round(list_dot_product(q.v, d.v)
               / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v))), 6) AS score
  FROM q, d),
ranked AS (
  SELECT qid, did, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) AS INTEGER) AS rank
  FROM s QUALIFY rank <= {K})
"""


@register("dense_topk", sql=f"WITH {SQL_DENSE_SCORES} SELECT qid, did, score, rank FROM ranked", ops="RET1 WIN1")
def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return R.exact_topk(dense_queries(spark, sf), dense_corpus(spark, sf), k=K, metric="cosine")


SQL_METRICS_TAIL = """
rel AS (SELECT qid, qid AS did FROM q),
rel_n AS (SELECT qid, count(*) AS n_rel FROM rel GROUP BY qid),
hits AS (
  SELECT r.qid, min(r.rank) AS first_hit,
         sum(CASE WHEN r.rank <= 1 THEN 1 ELSE 0 END) AS hits_1,
         sum(CASE WHEN r.rank <= 5 THEN 1 ELSE 0 END) AS hits_5,
         sum(CASE WHEN r.rank <= 10 THEN 1 ELSE 0 END) AS hits_10
  FROM ranked r WHERE r.rank <= 10 AND EXISTS (SELECT 1 FROM rel WHERE rel.qid = r.qid AND rel.did = r.did)
  GROUP BY r.qid),
per_q AS (SELECT rel_n.qid, n_rel, first_hit, hits_1, hits_5, hits_10 FROM rel_n LEFT JOIN hits USING (qid))
SELECT count(*) AS n_queries,
  round(avg(CASE WHEN first_hit <= 1 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_1,
  round(avg(CASE WHEN first_hit <= 5 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_5,
  round(avg(CASE WHEN first_hit <= 10 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_10,
  round(avg(CASE WHEN first_hit <= 10 THEN 1.0 / first_hit ELSE 0.0 END), 4) AS mrr_at_10,
  round(avg(coalesce(hits_1, 0) / least(1, n_rel)), 4) AS recall_at_1,
  round(avg(coalesce(hits_5, 0) / least(5, n_rel)), 4) AS recall_at_5,
  round(avg(coalesce(hits_10, 0) / least(10, n_rel)), 4) AS recall_at_10
FROM per_q
"""


@register("dense_metrics", sql=f"WITH {SQL_DENSE_SCORES}, {SQL_METRICS_TAIL}", ops="RET1 RET11 AGG8 AGG9 JON2")
def dense_metrics(spark: SparkSession, sf: str) -> DataFrame:
    ranked = dense_topk(spark, sf)
    return M.retrieval_metrics(ranked, dense_qrels(spark, sf), ks=(1, 5, 10))


# ---------------------------------------------------------------------------
# FIL4 / RET8 / RET13: nested subsets and the knee report
# ---------------------------------------------------------------------------

# Fixed experiment parameters: share of vectors drawn as evaluation queries
# (md5 of "<id>-q" below the hex prefix "0a", about 1 in 25.6) and subset sizes
# as fractions of the corpus.
QUERY_HEX_BELOW = "0a"
SIZE_FRACTIONS = (0.1, 0.2, 0.5, 1.0)
SEED = 42


def eval_sample(e: DataFrame) -> DataFrame:
    """FIL3: seeded evaluation-query sample (a sampling operator)."""
    return e.filter(F.md5(F.concat(F.col("vec_id").cast("string"), F.lit("-q"))) < F.lit(QUERY_HEX_BELOW))


def scaling_results(spark: SparkSession, sf: str) -> DataFrame:
    """RET8: retrieval quality over nested subsets of growing size."""
    e = embeddings(spark, sf)
    ev = eval_sample(e)
    queries = query_vectors(ev)
    qrels = ev.select(F.col("vec_id").alias("qid"), F.col("vec_id").alias("did"))
    corpus = e.select(F.col("vec_id").alias("did"), "embedding")
    ranked_corpus = R.subset_rank(corpus, qrels, seed=SEED)
    n = corpus.select(F.count(F.lit(1))).scalar()
    sizes = F.array(*[F.ceil(n * F.lit(f)).cast("bigint") for f in SIZE_FRACTIONS])
    n_rel = qrels.select(F.count(F.lit(1))).scalar()
    # FIL4: too few distractors is an error, raised inside the job
    sized = ranked_corpus.withColumn("size", F.explode(sizes)).withColumn(
        "size", F.when(F.col("size") >= n_rel, F.col("size")).otherwise(
            F.raise_error(F.lit("subset smaller than the relevant set")).cast("bigint")))
    sized = sized.filter(F.col("subset_rank") <= F.col("size"))
    ranked = R.exact_topk(queries, sized, k=K, by="size")
    qrels_by = qrels.withColumn("size", F.explode(sizes))
    return M.retrieval_metrics(ranked, qrels_by, ks=(1, 5, 10), by=["size"]).drop(
        "recall_at_1", "recall_at_5", "recall_at_10")


SQL_SCALING = f"""
e AS (SELECT * FROM embeddings),
ev AS (SELECT * FROM e WHERE md5(CAST(vec_id AS VARCHAR) || '-q') < '{QUERY_HEX_BELOW}'),
n AS (SELECT count(*) AS n FROM e),
sizes AS (SELECT CAST(ceil(n * f) AS BIGINT) AS size FROM n, (VALUES {", ".join(f"({f})" for f in SIZE_FRACTIONS)}) t(f)),
rc AS (
  SELECT e.vec_id AS did, CAST(e.embedding AS DOUBLE[]) AS v,
         row_number() OVER (ORDER BY CASE WHEN ev.vec_id IS NULL THEN 1 ELSE 0 END,
                                     md5(CAST(e.vec_id AS VARCHAR) || '-{SEED}'), e.vec_id) AS subset_rank
  FROM e LEFT JOIN ev ON e.vec_id = ev.vec_id),
q AS (SELECT vec_id AS qid, {SQL_NOISY} AS v FROM ev),
s AS (
  SELECT sizes.size, q.qid, rc.did,
         round(list_dot_product(q.v, rc.v)
               / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(rc.v, rc.v))), 6) AS score
  FROM q, rc, sizes WHERE rc.subset_rank <= sizes.size),
ranked AS (
  SELECT size, qid, did, row_number() OVER (PARTITION BY size, qid ORDER BY score DESC, did) AS rank
  FROM s QUALIFY rank <= {K}),
per_q AS (
  SELECT sizes.size, ev.vec_id AS qid, min(r.rank) AS first_hit
  FROM ev CROSS JOIN sizes LEFT JOIN ranked r ON r.size = sizes.size AND r.qid = ev.vec_id AND r.did = ev.vec_id
  GROUP BY sizes.size, ev.vec_id),
results AS (
  SELECT size, count(*) AS n_queries,
    round(avg(CASE WHEN first_hit <= 1 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_1,
    round(avg(CASE WHEN first_hit <= 5 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_5,
    round(avg(CASE WHEN first_hit <= 10 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_10,
    round(avg(CASE WHEN first_hit <= 10 THEN 1.0 / first_hit ELSE 0.0 END), 4) AS mrr_at_10
  FROM per_q GROUP BY size)
"""


@register("nested_subset_scaling", sql=f"WITH {SQL_SCALING} SELECT * FROM results",
          ops="FIL3 FIL4 RET8 RET1 AGG8")
def nested_subset_scaling(spark: SparkSession, sf: str) -> DataFrame:
    return scaling_results(spark, sf)


KNEE_METRICS = ("hit_rate_at_1", "hit_rate_at_5", "hit_rate_at_10", "mrr_at_10")

SQL_KNEE = f"""
WITH {SQL_SCALING},
long AS (
  SELECT size, metric, now FROM (SELECT *, CAST(size AS DOUBLE) AS work FROM results)
  UNPIVOT (now FOR metric IN ({", ".join(KNEE_METRICS)}, work))),
b AS (SELECT metric, arg_min(now, size) AS base, min(size) AS first_size FROM long GROUP BY metric)
SELECT long.size, long.metric, CAST(long.now AS DOUBLE) AS now, CAST(b.base AS DOUBLE) AS base,
       round(CASE WHEN metric = 'work' THEN long.now / greatest(b.base, 0.01) ELSE (b.base - long.now) / b.base END, 4) AS magnitude
FROM long JOIN b USING (metric)
WHERE long.size <> b.first_size
  AND CASE WHEN metric = 'work' THEN long.now / greatest(b.base, 0.01) >= 3 ELSE (b.base - long.now) / b.base >= 0.02 END
"""


@register("knee_report", sql=SQL_KNEE, ops="RET13 WIN5")
def knee_report(spark: SparkSession, sf: str) -> DataFrame:
    """Quality metrics that fell by 2 % or more from the smallest size, and the
    work per query (vectors scored, in place of a latency) where it has grown
    three times."""
    r = scaling_results(spark, sf).withColumn("work", F.col("size").cast("double"))
    return M.knee(r, "size", KNEE_METRICS, latency="work", drop=0.02, growth=3.0)


# ---------------------------------------------------------------------------
# Lexical task: corpus = documents, queries = benchmark passages,
# relevant = documents containing the passage verbatim
# ---------------------------------------------------------------------------

TOKEN_RE = "[a-z0-9]+"
HEX = "0123456789abcdef"


def lexical_inputs(spark: SparkSession, sf: str):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("did"), "text")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return docs, items


def lexical_index(spark: SparkSession, docs: DataFrame) -> dict:
    """The corpus's index from the shared folder, built by the first query that
    asks for this version of the corpus."""
    return R.bm25_stored(docs, scratch_path(spark, "bm25-v2"))


def bm25_ranked(spark: SparkSession, sf: str, k: int = 100):
    docs, items = lexical_inputs(spark, sf)
    index = lexical_index(spark, docs)
    return R.bm25_topk(items, docs, index, k=k), index


SQL_BM25 = f"""
toks AS (SELECT doc_id AS did, regexp_extract_all(lower(text), '{TOKEN_RE}') AS t FROM documents),
docs AS (SELECT did, len(t) AS dl FROM toks),
post AS (SELECT term, did, count(*) AS tf FROM (SELECT did, unnest(t) AS term FROM toks) GROUP BY term, did),
stats AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM docs),
dft AS (SELECT term, count(*) AS df FROM post GROUP BY term),
raw AS (SELECT term, df, ln(n_docs - df + 0.5) - ln(df + 0.5) AS raw_idf FROM dft, stats),
idf AS (SELECT term, CASE WHEN raw_idf < 0 THEN 0.25 * (SELECT avg(raw_idf) FROM raw) ELSE raw_idf END AS idf FROM raw),
qt AS (SELECT qid, term, count(*) AS qtf
       FROM (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), '{TOKEN_RE}')) AS term FROM benchmark)
       GROUP BY qid, term),
bm25_scores AS (
  SELECT qt.qid, post.did,
         round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
  FROM qt JOIN idf USING (term) JOIN post USING (term) JOIN docs USING (did), stats
  GROUP BY qt.qid, post.did),
bm25_ranked AS (
  SELECT qid, did, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) AS INTEGER) AS rank
  FROM bm25_scores QUALIFY rank <= 100)
"""


@register("bm25_topk", sql=f"WITH {SQL_BM25} SELECT qid, did, score, rank FROM bm25_ranked WHERE rank <= 10",
          ops="RET3 FUN1 WIN1 SRT1")
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    ranked, _ = bm25_ranked(spark, sf)
    return ranked.filter(F.col("rank") <= 10)


SQL_QRELS = """
lex_qrels AS (SELECT b.item_id AS qid, d.doc_id AS did FROM benchmark b JOIN documents d ON contains(d.text, b.text))
"""


@register("lexical_qrels", sql=f"WITH {SQL_QRELS} SELECT qid, did FROM lex_qrels", ops="JON4")
def lexical_qrels(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = lexical_inputs(spark, sf)
    return R.containment_pairs(items, docs, lexical_index(spark, docs))


def _hashed_sql(src: str, id_col: str, name: str) -> str:
    bucket = (f"(instr('{HEX}', substr(md5(term), 1, 1)) - 1) * 16 + (instr('{HEX}', substr(md5(term), 2, 1)) - 1)")
    return f"""
{name}_b AS (
  SELECT id, {bucket} AS bucket, count(*) AS cnt
  FROM (SELECT {id_col} AS id, unnest(regexp_extract_all(lower(text), '{TOKEN_RE}')) AS term FROM {src})
  GROUP BY ALL),
{name} AS (SELECT id, bucket, cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY id)) AS w FROM {name}_b)"""


SQL_DENSE_LEX = f"""
{_hashed_sql('benchmark', 'item_id', 'hq')},
{_hashed_sql('documents', 'doc_id', 'hd')},
hashed_scores AS (
  SELECT hq.id AS qid, hd.id AS did, round(sum(hq.w * hd.w), 6) AS score
  FROM hq JOIN hd USING (bucket) GROUP BY ALL),
dense_ranked AS (
  SELECT qid, did, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) AS INTEGER) AS rank
  FROM hashed_scores QUALIFY rank <= 10)
"""


def hashed_dense_ranked(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.embed import hashed_embedding

    docs, items = lexical_inputs(spark, sf)
    dq = hashed_embedding(items, "qid", "text")
    dd = hashed_embedding(docs, "did", "text")
    return R.exact_topk(dq, dd, k=10, metric="cosine", spread=False)  # the texts are spread already


@register("hashed_dense_topk", sql=f"WITH {SQL_DENSE_LEX} SELECT qid, did, score, rank FROM dense_ranked",
          ops="RET9 RET1")
def hashed_dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return hashed_dense_ranked(spark, sf)


SQL_RRF = """
rrf_in AS (
  SELECT qid, did, rank, 0 AS list_no FROM dense_ranked
  UNION ALL SELECT qid, did, rank, 1 AS list_no FROM bm25_ranked WHERE rank <= 10),
rrf_f AS (
  SELECT qid, did, round(sum(1.0 / (60 + rank)), 6) AS score, min(list_no * 1000000 + rank) AS first_seen
  FROM rrf_in GROUP BY qid, did),
rrf_ranked AS (
  SELECT qid, did, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_seen, did) AS INTEGER) AS rank
  FROM rrf_f QUALIFY rank <= 10)
"""


def rrf_ranked(spark: SparkSession, sf: str) -> DataFrame:
    bm, _ = bm25_ranked(spark, sf)
    return R.rrf([hashed_dense_ranked(spark, sf), bm.filter(F.col("rank") <= 10)], k=60, top_k=10)


@register("rrf_hybrid", sql=f"WITH {SQL_BM25}, {SQL_DENSE_LEX}, {SQL_RRF} SELECT qid, did, score, rank FROM rrf_ranked",
          ops="RET4 WIN10 SET1")
def rrf_hybrid(spark: SparkSession, sf: str) -> DataFrame:
    return rrf_ranked(spark, sf)


SQL_RERANK = f"""
pairs AS (
  SELECT r.qid, r.did, r.rank AS first_rank,
         list_distinct(regexp_extract_all(lower(b.text), '{TOKEN_RE}')) AS qt,
         list_distinct(regexp_extract_all(lower(d.text), '{TOKEN_RE}')) AS dt
  FROM bm25_ranked r JOIN benchmark b ON b.item_id = r.qid JOIN documents d ON d.doc_id = r.did),
rr AS (
  SELECT qid, did, first_rank,
         round(CASE WHEN len(qt) > 0 THEN len(list_intersect(qt, dt)) / len(qt) ELSE 0.0 END, 6) AS score
  FROM pairs),
rerank_ranked AS (
  SELECT qid, did, first_rank, score,
         CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_rank, did) AS INTEGER) AS rank
  FROM rr QUALIFY rank <= 10)
"""


def rerank_ranked(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = lexical_inputs(spark, sf)
    bm, _ = bm25_ranked(spark, sf, k=100)
    return R.rerank(bm, items, docs, top_k=10)


@register("rerank_two_stage", sql=f"WITH {SQL_BM25}, {SQL_RERANK} SELECT qid, did, first_rank, score, rank FROM rerank_ranked",
          ops="RET5 UDF3 JON4")
def rerank_two_stage(spark: SparkSession, sf: str) -> DataFrame:
    return rerank_ranked(spark, sf)


def _metrics_sql(src: str, name: str) -> str:
    return f"""
SELECT '{name}' AS retriever, count(*) AS n_queries,
  round(avg(CASE WHEN first_hit <= 1 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_1,
  round(avg(CASE WHEN first_hit <= 5 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_5,
  round(avg(CASE WHEN first_hit <= 10 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_10,
  round(avg(CASE WHEN first_hit <= 10 THEN 1.0 / first_hit ELSE 0.0 END), 4) AS mrr_at_10,
  round(avg(coalesce(hits_10, 0) / least(10, n_rel)), 4) AS recall_at_10
FROM (SELECT qid, count(*) AS n_rel FROM lex_qrels GROUP BY qid) rn
LEFT JOIN (
  SELECT r.qid, min(r.rank) AS first_hit, count(*) AS hits_10
  FROM {src} r JOIN lex_qrels q ON q.qid = r.qid AND q.did = r.did WHERE r.rank <= 10 GROUP BY r.qid) h USING (qid)
"""


SQL_LEX_EVAL = f"""
WITH {SQL_BM25}, {SQL_DENSE_LEX}, {SQL_RRF}, {SQL_RERANK}, {SQL_QRELS}
{_metrics_sql('bm25_ranked', 'bm25')}
UNION ALL {_metrics_sql('dense_ranked', 'hashed_dense')}
UNION ALL {_metrics_sql('rrf_ranked', 'rrf')}
UNION ALL {_metrics_sql('rerank_ranked', 'rerank')}
"""


@register("lexical_retrieval_eval", sql=SQL_LEX_EVAL, ops="RET11 AGG8 AGG9 RET3 RET4 RET5 SET1")
def lexical_retrieval_eval(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = lexical_inputs(spark, sf)
    bm, index = bm25_ranked(spark, sf, k=100)
    bm = stored(bm, "bm25")
    dense = stored(hashed_dense_ranked(spark, sf), "dense")
    fused = R.rrf([dense, bm.filter(F.col("rank") <= 10)], k=60, top_k=10)
    rr = R.rerank(bm, items, docs, top_k=10)
    qrels = R.containment_pairs(items, docs, index)
    lists = [("bm25", bm.filter(F.col("rank") <= 10)), ("hashed_dense", dense), ("rrf", fused), ("rerank", rr)]
    u = None
    for name, df in lists:
        part = df.select(F.lit(name).alias("retriever"), "qid", "did", "rank")
        u = part if u is None else u.unionByName(part)
    q_by = qrels.withColumn("retriever", F.explode(F.array(*[F.lit(n) for n, _ in lists])))
    return M.retrieval_metrics(u, q_by, ks=(1, 5, 10), by=["retriever"]).drop("recall_at_1", "recall_at_5")


# ---------------------------------------------------------------------------
# RET6 / RET7 / AGG10 / RET12: IVF probe sweep, recall vs exact, Pareto
# ---------------------------------------------------------------------------

NPROBES = (1, 2, 4, 8, 16)
LLOYD_ROUNDS = 2


def ivf_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Cells: seeded by round(sqrt(N)) vectors (md5 order), so that their number
    grows with the corpus, then trained by two Lloyd rounds."""
    e = embeddings(spark, sf)
    n_cells = int(e.select(F.floor(F.sqrt(F.count(F.lit(1))) + 0.5)).first()[0])
    key = F.md5(F.concat(F.col("vec_id").cast("string"), F.lit("-c")))
    picked = e.select("vec_id", "embedding", key.alias("_k")).orderBy("_k", "vec_id").limit(n_cells)
    seeds = picked.select(F.row_number().over(Window.orderBy("_k", "vec_id")).alias("cell"), F.col("embedding").alias("centroid"))
    return R.train_cells(dense_corpus(spark, sf), seeds, LLOYD_ROUNDS)


def ivf_parts(spark: SparkSession, sf: str):
    """The stored index (clustered by cell), the probes and the approximate
    lists, each built once."""
    queries = dense_queries(spark, sf)
    cents = ivf_centroids(spark, sf)
    path = scratch_path(spark, f"ivf-{uuid.uuid4().hex}")
    R.save_ivf(R.ivf_build(dense_corpus(spark, sf), cents), path)
    index = spark.read.parquet(path)
    probes = stored(R.ivf_probes(queries, cents, max(NPROBES)), "probes")
    approx = stored(R.ivf_topk(queries, index, cents, k=K, nprobes=NPROBES, probes=probes), "approximate")
    return index, probes, approx


def ivf_sweep(spark: SparkSession, sf: str) -> DataFrame:
    index, probes, approx = ivf_parts(spark, sf)
    exact = dense_topk(spark, sf)
    qrels = dense_qrels(spark, sf).withColumn("nprobe", F.explode(F.array(*[F.lit(p) for p in NPROBES])))
    quality = M.retrieval_metrics(approx, qrels, ks=(1, 10), by=["nprobe"]).drop("recall_at_1", "recall_at_10")
    vs_exact = M.recall_vs_exact(approx, exact, k=K, by="nprobe", values=NPROBES).drop("n_queries")
    cost = R.ivf_cost(probes, index, NPROBES).groupBy("nprobe").agg(
        F.round(F.avg("candidates"), 4).alias("avg_candidates"))
    return quality.join(vs_exact, "nprobe").join(cost, "nprobe")


def _lloyd_sql() -> str:
    cos = ("round(list_dot_product(d.v, c.c) / (sqrt(list_dot_product(d.v, d.v)) * sqrt(list_dot_product(c.c, c.c))), 6)")
    out = ["""cent0 AS (
  SELECT row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || '-c'), vec_id) AS cell, CAST(embedding AS DOUBLE[]) AS c
  FROM embeddings QUALIFY cell <= (SELECT floor(sqrt(n) + 0.5) FROM ne))"""]
    for r in range(LLOYD_ROUNDS):
        out.append(f"""near{r} AS (
  SELECT d.did, d.v, c.cell FROM d, cent{r} c
  QUALIFY row_number() OVER (PARTITION BY d.did ORDER BY {cos} DESC, c.cell) = 1),
mean{r} AS (
  SELECT cell, list(x ORDER BY pos) AS m FROM (
    SELECT cell, pos, round(avg(x), 6) AS x FROM (SELECT cell, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM near{r}) GROUP BY cell, pos)
  GROUP BY cell),
cent{r + 1} AS (SELECT c.cell, coalesce(m.m, c.c) AS c FROM cent{r} c LEFT JOIN mean{r} m USING (cell))""")
    out.append(f"cent AS (SELECT * FROM cent{LLOYD_ROUNDS})")
    return ",\n".join(out)


SQL_IVF = f"""
{SQL_DENSE_SCORES},
ne AS (SELECT count(*) AS n FROM embeddings),
{_lloyd_sql()},
assign AS (
  SELECT d.did, cent.cell,
         row_number() OVER (PARTITION BY d.did ORDER BY
           round(list_dot_product(d.v, cent.c) / (sqrt(list_dot_product(d.v, d.v)) * sqrt(list_dot_product(cent.c, cent.c))), 6) DESC,
           cent.cell) AS r
  FROM d, cent QUALIFY r = 1),
probe AS (
  SELECT q.qid, cent.cell,
         row_number() OVER (PARTITION BY q.qid ORDER BY
           round(list_dot_product(q.v, cent.c) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(cent.c, cent.c))), 6) DESC,
           cent.cell) AS cell_rank
  FROM q, cent),
np AS (SELECT * FROM (VALUES {", ".join(f"({p})" for p in NPROBES)}) t(nprobe)),
cand AS (
  SELECT np.nprobe, s.qid, s.did, s.score
  FROM np JOIN probe p ON p.cell_rank <= np.nprobe JOIN assign a ON a.cell = p.cell
  JOIN s ON s.qid = p.qid AND s.did = a.did),
approx AS (
  SELECT nprobe, qid, did, row_number() OVER (PARTITION BY nprobe, qid ORDER BY score DESC, did) AS rank
  FROM cand QUALIFY rank <= {K}),
quality AS (
  SELECT np.nprobe, count(*) AS n_queries,
    round(avg(CASE WHEN h.first_hit <= 1 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_1,
    round(avg(CASE WHEN h.first_hit <= 10 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate_at_10,
    round(avg(CASE WHEN h.first_hit <= 10 THEN 1.0 / h.first_hit ELSE 0.0 END), 4) AS mrr_at_10
  FROM np CROSS JOIN (SELECT qid FROM q) e
  LEFT JOIN (SELECT nprobe, qid, min(rank) AS first_hit FROM approx WHERE qid = did GROUP BY ALL) h
    ON h.nprobe = np.nprobe AND h.qid = e.qid
  GROUP BY np.nprobe),
vs AS (
  SELECT a.nprobe, a.qid, count(r.did) AS n_common
  FROM approx a LEFT JOIN ranked r ON r.qid = a.qid AND r.did = a.did GROUP BY ALL),
vs_exact AS (
  SELECT np.nprobe, round(avg(coalesce(n_common, 0) / least({K}, n_exact)), 4) AS recall_vs_exact_at_{K}
  FROM np CROSS JOIN (SELECT qid, count(*) AS n_exact FROM ranked GROUP BY qid) x
  LEFT JOIN vs ON vs.nprobe = np.nprobe AND vs.qid = x.qid GROUP BY np.nprobe),
sizes AS (SELECT cell, count(*) AS cell_size FROM assign GROUP BY cell),
cost AS (
  SELECT nprobe, round(avg(c), 4) AS avg_candidates FROM (
    SELECT np.nprobe, p.qid, sum(coalesce(sizes.cell_size, 0)) AS c
    FROM np JOIN probe p ON p.cell_rank <= np.nprobe LEFT JOIN sizes ON sizes.cell = p.cell GROUP BY ALL) GROUP BY nprobe),
sweep AS (SELECT * FROM quality JOIN vs_exact USING (nprobe) JOIN cost USING (nprobe))
"""


@register("ivf_probe_sweep", sql=f"WITH {SQL_IVF} SELECT * FROM sweep", ops="RET6 RET7 SNK9 AGG10 JON3 SET2")
def ivf_probe_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return ivf_sweep(spark, sf)


@register("recall_vs_exact", sql=f"WITH {SQL_IVF} SELECT nprobe, recall_vs_exact_at_{K} FROM sweep",
          ops="AGG10 JON3")
def recall_vs_exact(spark: SparkSession, sf: str) -> DataFrame:
    _, _, approx = ivf_parts(spark, sf)
    return M.recall_vs_exact(approx, dense_topk(spark, sf), k=K, by="nprobe", values=NPROBES).drop("n_queries")


SQL_PARETO = f"""
WITH {SQL_IVF}
SELECT nprobe, avg_candidates, hit_rate_at_10, recall_vs_exact_at_{K},
  hit_rate_at_10 > coalesce(max(hit_rate_at_10) OVER (ORDER BY avg_candidates, hit_rate_at_10 DESC, nprobe
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-infinity'::DOUBLE) AS on_frontier_qrels,
  recall_vs_exact_at_{K} > coalesce(max(recall_vs_exact_at_{K}) OVER (ORDER BY avg_candidates, recall_vs_exact_at_{K} DESC, nprobe
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-infinity'::DOUBLE) AS on_frontier_exact
FROM sweep
"""


@register("pareto_frontier", sql=SQL_PARETO, ops="RET12 WIN2")
def pareto_frontier(spark: SparkSession, sf: str) -> DataFrame:
    sweep = ivf_sweep(spark, sf).select("nprobe", "avg_candidates", "hit_rate_at_10", f"recall_vs_exact_at_{K}")
    a = M.pareto(sweep, "avg_candidates", "hit_rate_at_10", tie="nprobe", flag="on_frontier_qrels")
    return M.pareto(a, "avg_candidates", f"recall_vs_exact_at_{K}", tie="nprobe", flag="on_frontier_exact")
