"""Retrieval jobs: exact dense top-k, filtered search, nested subsets, BM25,
reciprocal-rank fusion, two-stage rerank and an IVF approximate index.

Ranked results are long tables ``(qid, did, score, rank)``; rank is 1-based
and ties are broken by ``did`` ascending (the reference leaves them arbitrary).
"""

from __future__ import annotations

import functools
import json
import math
import re
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import move, path_exists, scratch_path
from .common import ensure_parallel, global_row_number, stored

# ---------------------------------------------------------------------------
# WIN1 / SRT1: top-k per group
# ---------------------------------------------------------------------------


def topk_per_group(df: DataFrame, k: int, group: Sequence[str], score: str = "score", tie: str = "did",
                   rank_col: str = "rank", decimals: int | None = 6) -> DataFrame:
    """WIN1 / SRT1: keep the best ``k`` rows per group by ``score`` desc, ``tie`` asc.

    ``row_number() <= k`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle and a final one after it, so at most ``k`` rows per group and
    input partition cross the network.
    """
    s = F.round(F.col(score), decimals) if decimals is not None else F.col(score)
    if decimals is not None:
        df = df.withColumn(score, s)
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


# ---------------------------------------------------------------------------
# RET1 / RET15: exact dense top-k
# ---------------------------------------------------------------------------

DEFAULT_BLOCK_BYTES = 64 << 20  # largest block shipped to every task
TILE_SCORES = 1 << 20  # scores held at a time: rows x queries
TILE_ROWS = 1 << 10  # most rows of a tile


def _stack(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def _prepare(m: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine" and m.size:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        n[n == 0] = 1.0
        return m / n
    return m


def _score_block(metric: str, docs: np.ndarray, q: np.ndarray, q_sq: np.ndarray) -> np.ndarray:
    s = docs @ q.T  # (n_docs, n_queries)
    if metric in ("l2", "euclidean"):
        d_sq = (docs * docs).sum(axis=1)[:, None]
        s = -np.sqrt(np.maximum(d_sq + q_sq[None, :] - 2.0 * s, 0.0))
    return s


def _merge_topk(gi: np.ndarray, qi: np.ndarray, dd: np.ndarray, sc: np.ndarray, k: int) -> np.ndarray:
    """Indices of the exact top-k per (group, query) under (score desc, did asc)."""
    if qi.size == 0:
        return np.zeros(0, dtype=np.int64)
    tie = dd if dd.dtype != object else np.asarray(dd, dtype=str)
    order = np.lexsort((tie, -sc, qi, gi))
    g2, q2 = gi[order], qi[order]
    new = np.r_[True, (np.diff(g2) != 0) | (np.diff(q2) != 0)]
    starts = np.flatnonzero(new)
    group_start = np.repeat(starts, np.diff(np.r_[starts, qi.size]))
    keep = (np.arange(qi.size) - group_start) < k
    return order[keep]


class _RunningTopK:
    """Exact top-k per (group, query) over tiles of scores that come one after
    the other. Queries come in tiles that start at the same places every time;
    what is held is ``k`` entries per query and one tile's candidates."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, group: int, q0: int, ids: np.ndarray, s: np.ndarray, above: float = -np.inf) -> None:
        """Scores ``s`` (rows x queries from ``q0``) of the rows ``ids``; only those over ``above`` count."""
        kk = min(self.k, len(s))
        kth = -np.partition(-s, kk - 1, axis=0)[kk - 1]  # tie-inclusive: every score >= the k-th best
        q, d, v, floor = self.held.get((group, q0), (None, None, None, -np.inf))
        kth = np.fmax(kth, floor)
        hit = s >= kth[None, :]
        rows, cols = np.nonzero(hit if above == -np.inf else hit & (s > above))
        if not rows.size:
            return
        new = cols.astype(np.int64), ids[rows], s[rows, cols]
        if q is not None:
            new = tuple(np.concatenate([a, b]) for a, b in zip((q, d, v), new, strict=True))
        keep = _merge_topk(np.zeros(new[0].size, np.int64), *new, self.k)
        q, d, v = (x[keep] for x in new)
        n = np.bincount(q, minlength=s.shape[1])
        floor = np.full(s.shape[1], -np.inf)
        floor[n == self.k] = v[np.cumsum(n)[n == self.k] - 1]
        self.held[group, q0] = q, d, v, floor

    def rows(self):
        """``(group, query, id, score)`` arrays, one tile of queries at a time."""
        for (group, q0), (q, d, v, _) in self.held.items():
            yield group, q + q0, d, v


def exact_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine",
               qid: str = "qid", qvec: str = "embedding", did: str = "did", dvec: str = "embedding",
               by: str | None = None, decimals: int = 6, block_bytes: int = DEFAULT_BLOCK_BYTES, spread: bool = True) -> DataFrame:
    """RET1 / RET15: exact top-k of every query over the whole corpus.

    The corpus is never shuffled (but for a small one, which is dealt over the
    cluster first unless ``spread`` is off): each task scores its own Arrow
    batches against a broadcast block of query vectors, tile by tile (at most
    ``TILE_SCORES`` scores are held), and keeps a running exact top-k per query
    (at most ``k`` rows per query are held and leave a task). A final
    ``row_number`` merge per query picks the global top-k (planned as a partial
    + final ``WindowGroupLimit``). The query side is shipped in blocks of at
    most ``block_bytes``; a larger query set takes one pass over the corpus per
    block.

    ``by`` names an integer corpus column (e.g. a subset size): top-k is then
    kept per ``(by, qid)``, so several nested corpora are searched in one pass.
    """
    spark = queries.sparkSession
    qid_type = queries.schema[qid].dataType.simpleString()
    did_type = corpus.schema[did].dataType.simpleString()
    q = queries.select(F.col(qid).alias("_qid"), F.col(qvec).alias("_qv"))
    stats = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_qv")).alias("d")).first()
    n_q, dim = int(stats["n"] or 0), int(stats["d"] or 0)
    by_out = f"{by} bigint, " if by else ""
    out_schema = f"{by_out}qid {qid_type}, did {did_type}, score double"
    if n_q == 0:
        return spark.createDataFrame([], out_schema)
    n_blocks = max(1, math.ceil(n_q * max(dim, 1) * 8 / block_bytes))
    if n_blocks > 1:
        q = q.withColumn("_blk", F.pmod(F.xxhash64("_qid"), F.lit(n_blocks)))

    doc_cols = [F.col(did).alias("did"), F.col(dvec).alias("_dv")]
    if by:
        doc_cols.append(F.col(by).cast("bigint").alias("_grp"))
    docs = ensure_parallel(corpus.select(*doc_cols)) if spread else corpus.select(*doc_cols)
    parts = []
    for b in range(n_blocks):
        block = q if n_blocks == 1 else q.filter(F.col("_blk") == b)
        pdf = block.select("_qid", "_qv").toPandas()  # bounded by block_bytes
        if len(pdf) == 0:
            continue
        qmat = _prepare(_stack(pdf["_qv"]), metric)
        bc = spark.sparkContext.broadcast((pdf["_qid"].to_numpy(), qmat))

        def score_partition(batches, bc=bc):
            q_ids, qm = bc.value
            q_sq = (qm * qm).sum(axis=1)
            best, step = _RunningTopK(k), max(1, TILE_SCORES // TILE_ROWS)
            for whole in batches:
                for at in range(0, len(whole), TILE_ROWS):
                    pdf_docs = whole.iloc[at:at + TILE_ROWS]
                    dm = _prepare(_stack(pdf_docs["_dv"]), metric)
                    grp = pdf_docs["_grp"].to_numpy(dtype=np.int64) if "_grp" in pdf_docs else np.zeros(len(pdf_docs), np.int64)
                    dids = pdf_docs["did"].to_numpy()
                    for g in np.unique(grp):
                        sel = np.flatnonzero(grp == g)
                        own = dm if len(sel) == len(dm) else dm[sel]
                        for q0 in range(0, len(qm), step):
                            best.add(int(g), q0, dids[sel], np.round(_score_block(metric, own, qm[q0:q0 + step], q_sq[q0:q0 + step]), decimals))
            for g, at_q, d, s in best.rows():
                out = {"qid": q_ids[at_q], "did": d, "score": s}
                yield pd.DataFrame({by: np.full(len(d), g), **out} if by else out)

        parts.append(docs.mapInPandas(score_partition, out_schema))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return topk_per_group(scored, k, ([by] if by else []) + ["qid"], decimals=decimals)


def filtered_topk(queries: DataFrame, corpus: DataFrame, k: int, predicate: Column | None = None, **kw) -> DataFrame:
    """RET2: predicate first (pushed to the scan), then exact top-k."""
    if predicate is not None:
        corpus = corpus.filter(predicate)
    return exact_topk(queries, corpus, k, **kw)


# ---------------------------------------------------------------------------
# FIL4 / RET8: nested seeded subsets
# ---------------------------------------------------------------------------


def seeded_key(id_col: str, seed: int | str) -> Column:
    """Deterministic pseudo-random order key, identical in DuckDB: md5(id || '-' || seed)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def subset_rank(corpus: DataFrame, relevant_ids: DataFrame, seed: int = 42, did: str = "did") -> DataFrame:
    """FIL4: position of every corpus row in the nested subset order.

    All relevant documents come first, then distractors by a seeded hash, then
    id. A subset of size ``s`` is ``subset_rank <= s``: subsets for one seed
    are nested by construction. The rank is a distributed global row number
    (range-partitioned sort + per-partition offsets), never a one-task window.
    """
    rel = relevant_ids.select(F.col(did).alias("_rel_id")).distinct()
    c = corpus.join(rel, corpus[did] == rel["_rel_id"], "left")
    c = c.withColumn("is_distractor", F.col("_rel_id").isNull().cast("int")).drop("_rel_id")
    c = c.withColumn("_h", seeded_key(did, seed))
    return global_row_number(c, ["is_distractor", "_h", did], "subset_rank").drop("_h")


# ---------------------------------------------------------------------------
# RET3: BM25 (Okapi, k1=1.5, b=0.75, epsilon=0.25)
# ---------------------------------------------------------------------------


def tokenize(text: Column) -> Column:
    """FUN1: lowercase ``[a-z0-9]+`` tokens (non-ASCII letters split words)."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)


TOKEN_CHARS = 4 << 20  # characters of texts whose term counts are given out at a time


def _term_counts(docs: DataFrame) -> DataFrame:
    """``(did, text)`` -> ``(did, terms, tfs, dls)``: the distinct tokens of each
    text that has any, how often each occurs, and the text's number of tokens
    (beside each term), counted where the row lies."""
    from collections import Counter

    import pyarrow as pa

    kind = docs.schema["did"].dataType.simpleString()
    schema = f"did {kind}, terms array<string>, tfs array<int>, dls array<int>"
    word = re.compile(WORD)

    def fn(batches):
        for b in batches:
            at, sizes, terms, tfs, dl, n = [], [], [], [], [], 0

            def out():
                ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind)) for x, kind in (
                    (terms, pa.string()), (tfs, pa.int32()), (np.repeat(np.array(dl, dtype=np.int32), sizes), pa.int32()))]
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *lists], ["did", "terms", "tfs", "dls"])

            for i, value in enumerate(b.column(1)):
                text = value.as_py() or ""
                toks = word.findall(text)
                n += len(text)
                if toks:
                    c = Counter(toks)
                    at.append(i)
                    sizes.append(len(c))
                    terms.extend(c)
                    tfs.extend(c.values())
                    dl.append(len(toks))
                if at and n >= TOKEN_CHARS:
                    yield out()
                    at, sizes, terms, tfs, dl, n = [], [], [], [], [], 0
            if at:
                yield out()

    return ensure_parallel(docs).select("did", F.lower("text").alias("_t")).mapInArrow(fn, schema)


def postings_of(index: dict) -> DataFrame:
    """The index's postings ``(did, term, tf, dl)``, one row each."""
    z = F.arrays_zip("terms", "tfs", "dls")
    return index["documents"].select("did", F.explode(z).alias("_p")).select(
        "did", F.col("_p.terms").alias("term"), F.col("_p.tfs").alias("tf"), F.col("_p.dls").alias("dl"))


def _one_row_per_id(counted: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of ``repeated`` ids as one row each: counts of texts of one length
    are added up."""
    same = lambda df: df["did"].eqNullSafe(repeated["did"])
    several = counted.join(repeated, same(counted), "left_semi")
    p = postings_of({"documents": several}).groupBy("did", "dl", "term").agg(F.sum("tf").cast("int").alias("tf"))
    merged = p.groupBy("did").agg(F.collect_list(F.struct("term", "tf", "dl")).alias("_p")).select(
        "did", F.col("_p.term").alias("terms"), F.col("_p.tf").alias("tfs"), F.col("_p.dl").alias("dls"))
    return counted.join(repeated, same(counted), "left_anti").unionByName(merged)


def _build_index(corpus: DataFrame, path: str, did: str, text: str) -> None:
    spark = corpus.sparkSession
    docs = corpus.select(F.col(did).alias("did"), F.col(text).alias("text"))
    repeated = docs.groupBy("did").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("did")
    counted = _term_counts(docs)
    if not repeated.isEmpty():
        counted = _one_row_per_id(stored(counted, "term-counts"), stored(repeated, "repeated-ids"))
    counted.write.parquet(f"{path}/documents")
    postings = postings_of({"documents": spark.read.parquet(f"{path}/documents")})
    n_docs = docs.count()
    df_t = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))
    df_t.select("term", "df", (F.log(F.lit(n_docs) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw_idf"), "n").write.parquet(f"{path}/terms")
    total = spark.read.parquet(f"{path}/terms").agg(F.sum("n")).first()[0] or 0
    avgdl = total / n_docs if n_docs else 0.0
    spark.createDataFrame([(n_docs, float(avgdl))], "n_docs bigint, avgdl double").write.parquet(f"{path}/numbers")


def _read_index(spark, path: str) -> dict:
    n_docs, avgdl = spark.read.parquet(f"{path}/numbers").first()
    return {"documents": spark.read.parquet(f"{path}/documents"), "terms_raw": spark.read.parquet(f"{path}/terms").drop("n"),
            "n_docs": n_docs, "avgdl": avgdl}


def bm25_index(corpus: DataFrame, did: str = "did", text: str = "text") -> dict:
    """Build the BM25 index once, as tables in the shared scratch folder:
    ``documents (did, terms, tfs, dls)``, a row per document that has tokens;
    with ``terms_raw (term, df, raw_idf)``, ``n_docs`` and ``avgdl`` (documents
    without tokens count).

    A document's terms are counted where its row lies and stay with it, so
    neither tokens nor postings are shuffled; only the terms' frequencies are,
    added up per task first, and the postings of ids that come several times."""
    path = scratch_path(corpus.sparkSession, f"bm25-{uuid.uuid4().hex}")
    _build_index(corpus, path, did, text)
    return _read_index(corpus.sparkSession, path)


def bm25_stored(corpus: DataFrame, store: str, did: str = "did", text: str = "text") -> dict:
    """RET3: the index of :func:`bm25_index`, kept in the folder ``store`` per
    version of the corpus and built only for a version that is not there yet. A
    version is named by the number of documents and order-free sums of hashes
    over their ids and texts. It is put together beside its place and moved
    there whole, so readers never see a part of it."""
    spark = corpus.sparkSession
    sums = [F.sum(F.xxhash64(F.lit(seed), F.col(did), F.col(text)).cast("decimal(38,0)")) for seed in (1, 2)]
    n, a, b = corpus.agg(F.count(F.lit(1)), *sums).first()
    path = f"{store.rstrip('/')}/corpus-{n}-{(int(a or 0) % 2**64):016x}{(int(b or 0) % 2**64):016x}"
    if not path_exists(spark, path):
        made = f"{store.rstrip('/')}/making-{uuid.uuid4().hex}"
        _build_index(corpus, made, did, text)
        if not path_exists(spark, path):
            move(spark, made, path)
    return _read_index(spark, path)


BM25_TILE = 4 << 20  # numbers of a tile of documents x terms or terms x queries


def bm25_topk(queries: DataFrame, corpus: DataFrame, index: dict | None = None, k: int = 10,
              qid: str = "qid", qtext: str = "text", did: str = "did", dtext: str = "text", k1: float = 1.5,
              b: float = 0.75, eps: float = 0.25, decimals: int = 6, block_bytes: int = DEFAULT_BLOCK_BYTES) -> DataFrame:
    """RET3: Okapi BM25 top-k of every query over the whole corpus.

    Query-term weights are ``qtf * idf`` (idf from the index; negative idf
    becomes ``eps * mean idf`` as in the published package). Each task reads its
    documents' terms from the index, keeps those of the queries with their
    saturated frequencies, and multiplies tiles of documents x terms with terms
    x queries (at most ``BM25_TILE`` numbers each), keeping a running exact
    top-k per query (score desc, did asc). Postings are not shuffled, only ``k``
    rows per query leave a task, and posting lists are never joined to queries,
    so common terms make no hot keys and no pair rows. Weights are shipped in blocks of at most ``block_bytes``;
    a larger query set runs block by block. Documents without a query term are
    never returned.
    """
    spark = queries.sparkSession
    index = index or bm25_index(corpus, did, dtext)
    avgdl = float(index["avgdl"])
    raw = index["terms_raw"]
    mean_idf = raw.select(F.avg("raw_idf")).first()[0] or 0.0
    qt = queries.select(F.col(qid).alias("qid"), F.explode(tokenize(F.col(qtext))).alias("term"))
    qt = qt.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))
    weights = stored(qt.join(raw.select("term", "raw_idf"), "term").select(
        "qid", "term", (F.col("qtf") * F.when(F.col("raw_idf") < 0, F.lit(eps * mean_idf)).otherwise(F.col("raw_idf"))).alias("w")), "weights")
    blocks = weights.count() * 64 // block_bytes + 1
    did_type = corpus.schema[did].dataType.simpleString()
    out_schema = f"qid {queries.schema[qid].dataType.simpleString()}, did {did_type}, score double"
    parts = []
    for i in range(blocks):
        pdf = (weights if blocks == 1 else weights.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)).toPandas()  # one block
        if len(pdf) == 0:
            continue
        q_of, q_ids = pd.factorize(pdf["qid"], sort=True)
        t_of, terms = pd.factorize(pdf["term"], sort=True)
        bc = spark.sparkContext.broadcast((np.asarray(q_ids), q_of, t_of, pdf["w"].to_numpy(), list(terms)))
        scan = _bm25_scan(bc, k, decimals, k1, b, avgdl or 1.0)
        parts.append(index["documents"].select("did", "terms", "tfs", "dls").mapInArrow(scan, out_schema))
    if not parts:
        return spark.createDataFrame([], out_schema).withColumn("rank", F.lit(1))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return topk_per_group(scored, k, ["qid"], decimals=decimals)


def _bm25_scan(bc, k: int, decimals: int, k1: float, b: float, avgdl: float):
    import pyarrow as pa
    import pyarrow.compute as pc

    def flat(column, start: int, n: int):
        return column.slice(start, n).flatten()

    def scan(batches):
        q_ids, q_of, t_of, w, names = bc.value
        wanted, n_terms = pa.array(names, pa.string()), len(names)
        q_step = max(1, min(len(q_ids), BM25_TILE // n_terms))
        d_step = max(1, min(1024, BM25_TILE // max(n_terms, q_step)))
        best, dense = _RunningTopK(k), None
        for batch in batches:
            ids, terms, tfs, dls = batch.columns
            dids = ids.to_pandas().to_numpy()
            for d0 in range(0, len(dids), d_step):
                sizes = pc.list_value_length(terms.slice(d0, d_step)).to_numpy(zero_copy_only=False)
                tid = pc.index_in(flat(terms, d0, d_step), value_set=wanted)
                hit = np.flatnonzero(pc.is_valid(tid).to_numpy(zero_copy_only=False))
                if not hit.size:
                    continue
                row = np.repeat(np.arange(len(sizes)), sizes)[hit]
                tf, dl = (flat(x, d0, d_step).to_numpy(zero_copy_only=False)[hit] for x in (tfs, dls))
                sat = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
                place = row * n_terms + pc.fill_null(tid, 0).to_numpy(zero_copy_only=False)[hit]
                a = np.bincount(place, weights=sat, minlength=len(sizes) * n_terms).reshape(len(sizes), n_terms)
                for q0 in range(0, len(q_ids), q_step):
                    if dense is None or dense[0] != q0:
                        m = np.zeros((n_terms, min(q_step, len(q_ids) - q0)))
                        own = (q_of >= q0) & (q_of < q0 + q_step)
                        m[t_of[own], q_of[own] - q0] = w[own]
                        dense = q0, m
                    best.add(0, q0, dids[d0:d0 + d_step], np.round(a @ dense[1], decimals), above=0.0)
        for _, at_q, d, s in best.rows():
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"qid": q_ids[at_q], "did": d, "score": s}), preserve_index=False)

    return scan


# ---------------------------------------------------------------------------
# RET4: reciprocal-rank fusion
# ---------------------------------------------------------------------------


def rrf(ranked: Sequence[DataFrame], k: int = 60, top_k: int = 10, qid: str = "qid", did: str = "did",
        rank: str = "rank", decimals: int = 6) -> DataFrame:
    """RET4 / SET1 / WIN10: ``sum(1 / (k + rank))`` over any number of ranked lists.

    Ties keep first-seen order: the list number and rank of the first
    appearance break ties, then ``did``.
    """
    parts = []
    for i, r in enumerate(ranked):
        parts.append(r.select(F.col(qid).alias("qid"), F.col(did).alias("did"), F.col(rank).cast("int").alias("src_rank"),
                              F.lit(i).alias("list_no")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    fused = u.groupBy("qid", "did").agg(
        F.sum(F.lit(1.0) / (F.lit(k) + F.col("src_rank"))).alias("score"),
        F.min(F.struct("list_no", "src_rank")).alias("first_seen"),
    )
    fused = fused.withColumn("score", F.round("score", decimals))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("first_seen.list_no"), F.col("first_seen.src_rank"),
                                          F.col("did"))
    return fused.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k).drop("first_seen")


# ---------------------------------------------------------------------------
# RET5: two-stage rerank
# ---------------------------------------------------------------------------


def term_coverage(query_text: Column, doc_text: Column) -> Column:
    """Default pair scorer: share of distinct query tokens present in the doc."""
    qt = F.array_distinct(tokenize(query_text))
    dt = F.array_distinct(tokenize(doc_text))
    return F.when(F.size(qt) > 0, F.size(F.array_intersect(qt, dt)) / F.size(qt)).otherwise(F.lit(0.0))


WORD = "[a-z0-9]+"
LOADED: list[str] = []  # models loaded by this Python worker, in order


@functools.lru_cache(maxsize=4)
def _pair_model(spec: str) -> dict:
    """A pair model from its JSON ``{"power": p}``: a shared word counts with its
    length to the power p. Loaded once per worker and specification."""
    LOADED.append(spec)
    return json.loads(spec)


def model_scorer(spec: str) -> Callable[[Column, Column], Column]:
    """UDF3: a batch pair scorer as a Series-to-Series ``pandas_udf``: the
    weighted share of the query's words that the document has. The model behind
    it is loaded once in a Python worker, not per batch."""
    def score(query: pd.Series, doc: pd.Series) -> pd.Series:
        power = _pair_model(spec)["power"]
        out = np.zeros(len(query))
        words: dict[str, dict[str, float]] = {}
        for i, (q, d) in enumerate(zip(query, doc, strict=True)):
            if q not in words:
                words[q] = {w: len(w) ** power for w in set(re.findall(WORD, (q or "").lower()))}
            own = words[q]
            if own:
                out[i] = sum(own[w] for w in own.keys() & set(re.findall(WORD, (d or "").lower()))) / sum(own.values())
        return pd.Series(out)

    return F.pandas_udf(score, "double")


def rerank(ranked: DataFrame, queries: DataFrame, corpus: DataFrame, top_k: int = 10,
           scorer: Callable[[Column, Column], Column] | None = None, qid: str = "qid", qtext: str = "text",
           did: str = "did", dtext: str = "text", decimals: int = 6) -> DataFrame:
    """RET5 / JON4 / UDF3: attach pair texts to a first-stage list and re-sort by a pair score.

    ``scorer`` maps (query text, doc text) columns to a score column; it may be
    a built-in expression or a Series-to-Series ``pandas_udf`` (a model).
    First-stage rank breaks ties.
    """
    scorer = scorer or term_coverage
    q = queries.select(F.col(qid).alias("qid"), F.col(qtext).alias("_qt"))
    c = corpus.select(F.col(did).alias("did"), F.col(dtext).alias("_dt"))
    pairs = stored(ranked.select("qid", "did", F.col("rank").alias("first_rank")), "first-stage")  # known small: texts then stay where they lie
    pairs = pairs.join(c, "did").join(q, "qid")
    scored = pairs.select("qid", "did", "first_rank", F.round(scorer(F.col("_qt"), F.col("_dt")), decimals).alias("score"))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("first_rank"), F.col("did"))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)


# ---------------------------------------------------------------------------
# RET6 / RET7: IVF approximate search
# ---------------------------------------------------------------------------


def nearest_rows(big: DataFrame, small: DataFrame, m: int, key: str, vec: str, small_key: str, small_vec: str,
                 metric: str = "cosine", decimals: int = 6, max_bytes: int = DEFAULT_BLOCK_BYTES,
                 carry: Sequence[str] = (), floors: DataFrame | None = None) -> DataFrame:
    """For every row of ``big``, the ``m`` best rows of a smaller table (score
    desc, key asc) -> ``(key, near_key, near_rank, near_score, *carry)``.

    The smaller side is broadcast as a matrix, in blocks of at most
    ``max_bytes`` (one pass over ``big`` per block, merged by key); ``big`` is
    scored batch by batch where it lies, ``TILE_SCORES`` scores at a time. With
    ``floors`` (``small_key, floor``) the output is instead every smaller row
    whose score reaches its own floor, without ranks."""
    spark = big.sparkSession
    side = small.select(F.col(small_key).alias("_k"), F.col(small_vec).alias("_v"))
    if floors is not None:
        side = side.join(floors.select(F.col(small_key).alias("_k"), "floor"), "_k")
    st = side.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_v")).alias("d")).first()
    blocks = int(st["n"] or 0) * int(st["d"] or 1) * 8 // max_bytes + 1
    carry = [c for c in carry if c != key]
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = (f"{key} {kind(big, key)}, near_key {kind(small, small_key)}, near_rank int, near_score double"
              + "".join(f", {c} {kind(big, c)}" for c in carry))
    rows = ensure_parallel(big.select(key, vec, *[c for c in carry if c != vec]))
    parts = []
    for i in range(blocks):
        pdf = (side if blocks == 1 else side.filter(F.pmod(F.xxhash64("_k"), F.lit(blocks)) == i)).toPandas()  # one block
        if len(pdf) == 0:
            continue
        pdf = pdf.sort_values("_k", kind="stable")
        bc = spark.sparkContext.broadcast((pdf["_k"].to_numpy(), _prepare(_stack(pdf["_v"]), metric),
                                           pdf["floor"].to_numpy(dtype=np.float64) if floors is not None else None))
        parts.append(rows.mapInPandas(_nearest_scan(bc, m, key, vec, carry, metric, decimals), schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if len(parts) > 1 and floors is None:
        w = Window.partitionBy(key).orderBy(F.col("near_score").desc(), F.col("near_key"))
        out = out.withColumn("near_rank", F.row_number().over(w)).filter(F.col("near_rank") <= m)
    return out


def _nearest_scan(bc, m: int, key: str, vec: str, carry: Sequence[str], metric: str, decimals: int):
    def fn(batches):
        ks, cm, fa = bc.value
        c_sq = (cm * cm).sum(axis=1)
        mm = min(m, len(ks))
        step = max(1, TILE_SCORES // max(len(ks), 1))
        for whole in batches:
            for at in range(0, len(whole), step):
                b = whole.iloc[at:at + step]
                s = np.round(_score_block(metric, _prepare(_stack(b[vec]), metric), cm, c_sq), decimals)  # (rows, cells)
                if fa is None:
                    # stable sort on -score keeps the lower key first among ties
                    cols = np.argsort(-s, axis=1, kind="stable")[:, :mm].ravel()
                    rows = np.repeat(np.arange(len(b)), mm)
                    ranks = np.tile(np.arange(1, mm + 1), len(b))
                else:
                    rows, cols = np.nonzero(s >= fa[None, :])
                    ranks = np.zeros(len(rows))
                out = {key: b[key].to_numpy()[rows], "near_key": ks[cols], "near_rank": ranks.astype(np.int32), "near_score": s[rows, cols]}
                for c in carry:
                    out[c] = b[c].to_numpy()[rows]
                yield pd.DataFrame(out)

    return fn


def train_cells(corpus: DataFrame, seeds: DataFrame, rounds: int = 2, did: str = "did", vec: str = "embedding",
                metric: str = "cosine", decimals: int = 6) -> DataFrame:
    """RET6 training: Lloyd rounds from the seed cells ``(cell, centroid)``.
    Each round assigns every vector to its nearest cell and moves the cell to
    the mean of its vectors (rounded, so that the result does not depend on the
    order of addition); a cell that lost all vectors stays where it is."""
    cells = stored(seeds.select("cell", F.transform("centroid", lambda x: x.cast("double")).alias("centroid")), "cells")
    for _ in range(rounds):
        near = nearest_rows(corpus, cells, 1, did, vec, "cell", "centroid", metric, carry=[vec])
        parts = near.select(F.col("near_key").alias("cell"), F.posexplode(vec).alias("pos", "x"))
        means = parts.groupBy("cell", "pos").agg(F.round(F.avg(F.col("x").cast("double")), decimals).alias("x"))
        moved = means.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("_p"))  # one vector a cell
        cells = stored(cells.join(moved, "cell", "left").select(
            "cell", F.when(F.col("_p").isNotNull(), F.col("_p.x")).otherwise(F.col("centroid")).alias("centroid")), "cells")
    return cells


IVF_CHUNK_ROWS = 50_000  # most vectors one scoring task holds


def ivf_build(corpus: DataFrame, centroids: DataFrame, did: str = "did", vec: str = "embedding",
              metric: str = "cosine") -> DataFrame:
    """RET6 build: assign every vector to its nearest cell in place (the
    vector is carried through, no join back). Persist the result clustered by
    ``cell`` (``repartition('cell').sortWithinPartitions(did)``) so a probe
    reads only its cells."""
    near = nearest_rows(corpus, centroids, 1, did, vec, "cell", "centroid", metric, carry=[vec])
    return near.select(did, vec, F.col("near_key").alias("cell"))


def _cell_chunks(rows: DataFrame, chunk_rows: int, name: str) -> DataFrame:
    """One row per cell with the number of chunks its rows are cut into, so a
    hot cell is spread over several tasks."""
    return rows.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows))).cast("int").alias(name))


def ivf_probes(queries: DataFrame, centroids: DataFrame, m: int, qid: str = "qid", qvec: str = "embedding",
               metric: str = "cosine") -> DataFrame:
    """The ``m`` nearest cells of each query: ``(qid, cell, cell_rank, _qv)``."""
    near = nearest_rows(queries, centroids, m, qid, qvec, "cell", "centroid", metric, carry=[qvec])
    return near.select(F.col(qid).alias("qid"), F.col("near_key").alias("cell"), F.col("near_rank").alias("cell_rank"), F.col(qvec).alias("_qv"))


def ivf_topk(queries: DataFrame, index: DataFrame, centroids: DataFrame, k: int = 10, nprobes: Sequence[int] = (1,),
             qid: str = "qid", qvec: str = "embedding", did: str = "did", dvec: str = "embedding",
             metric: str = "cosine", decimals: int = 6, chunk_rows: int = IVF_CHUNK_ROWS, query_rows: int = 2_000,
             probes: DataFrame | None = None) -> DataFrame:
    """RET6/RET7: probe the ``nprobe`` nearest cells of each query and score
    only the vectors of those cells, for several probe counts in one job.

    Both sides of a cell are cut: its vectors into chunks of about
    ``chunk_rows``, the queries that probe it into chunks of about
    ``query_rows``; every pair of chunks is one ``cogroup`` task, which scores
    tile by tile and emits each query's exact top-k in that chunk. Top-k over
    the union of the first ``p`` cells is then the merge of those lists with
    ``cell_rank <= p``.
    """
    probes = probes if probes is not None else ivf_probes(queries, centroids, max(nprobes), qid, qvec, metric)
    probes = probes.filter(F.col("cell_rank") <= max(nprobes))
    chunks = _cell_chunks(index, chunk_rows, "n_chunks").join(_cell_chunks(probes, query_rows, "q_chunks"), "cell")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    q = probes.join(chunks, "cell").withColumn("q_chunk", own("qid", "q_chunks")).withColumn("chunk", each("n_chunks"))
    idx = index.select(F.col(did).alias("did"), F.col(dvec).alias("_dv"), "cell").join(chunks, "cell")
    idx = idx.withColumn("chunk", own("did", "n_chunks")).withColumn("q_chunk", each("q_chunks"))
    qid_type = queries.schema[qid].dataType.simpleString()
    did_type = index.schema[did].dataType.simpleString()

    def score_chunk(ipdf: pd.DataFrame, qpdf: pd.DataFrame) -> pd.DataFrame:
        if len(ipdf) == 0 or len(qpdf) == 0:
            return pd.DataFrame({"qid": [], "cell_rank": [], "did": [], "score": []})
        dm = _prepare(_stack(ipdf["_dv"]), metric)
        qm = _prepare(_stack(qpdf["_qv"]), metric)
        dids, out = ipdf["did"].to_numpy(), []
        step = max(1, TILE_SCORES // len(dm))
        for q0 in range(0, len(qm), step):
            tile = qm[q0:q0 + step]
            s = np.round(_score_block(metric, dm, tile, (tile * tile).sum(axis=1)), decimals)
            kk = min(k, s.shape[0])
            kth = -np.partition(-s, kk - 1, axis=0)[kk - 1]
            rows, cols = np.nonzero(s >= kth[None, :])
            keep = _merge_topk(np.zeros(rows.size, np.int64), cols.astype(np.int64), dids[rows], s[rows, cols], k)
            at = q0 + cols[keep]
            out.append(pd.DataFrame({"qid": qpdf["qid"].to_numpy()[at], "cell_rank": qpdf["cell_rank"].to_numpy()[at],
                                     "did": dids[rows[keep]], "score": s[rows, cols][keep]}))
        return pd.concat(out, ignore_index=True)

    keys = ["cell", "chunk", "q_chunk"]
    scored = idx.select(*keys, "did", "_dv").groupBy(*keys).cogroup(
        q.select(*keys, "qid", "cell_rank", "_qv").groupBy(*keys)).applyInPandas(
        score_chunk, f"qid {qid_type}, cell_rank int, did {did_type}, score double")
    sweep = scored.withColumn("nprobe", F.explode(F.array(*[F.lit(p) for p in sorted(set(nprobes))])))
    sweep = sweep.filter(F.col("cell_rank") <= F.col("nprobe")).drop("cell_rank")
    return topk_per_group(sweep, k, ["nprobe", "qid"], decimals=decimals)


def ivf_cost(probes: DataFrame, index: DataFrame, nprobes: Sequence[int]) -> DataFrame:
    """Vectors scored per query for each probe count: the sum of the sizes of
    the probed cells."""
    sizes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("cell_size"))
    p = probes.select("qid", "cell", "cell_rank").join(sizes, "cell", "left").fillna(0, ["cell_size"])
    p = p.withColumn("nprobe", F.explode(F.array(*[F.lit(x) for x in sorted(set(nprobes))]))).filter(
        F.col("cell_rank") <= F.col("nprobe"))
    return p.groupBy("nprobe", "qid").agg(F.sum("cell_size").alias("candidates"))


# ---------------------------------------------------------------------------
# Relevance by containment (stand-in qrels for the lexical task)
# ---------------------------------------------------------------------------


def containment_pairs(items: DataFrame, docs: DataFrame, index: dict, qid: str = "qid", qtext: str = "text",
                      did: str = "did", dtext: str = "text", pattern_block: int = 1_000, anchor_block: int = 500_000) -> DataFrame:
    """JON4: ``(qid, did)`` where the document text contains the item text verbatim.

    Candidates come from an equi-join of each item's rarest *interior* token
    (not the first or last, which may be glued to neighbouring characters in a
    document) with the index's terms where they lie (anchors are shipped in
    blocks of about ``anchor_block``); each candidate is verified with ``instr``. Every containing document holds that token, so nothing is
    missed, and no item is compared with the whole corpus. Items with fewer than
    three tokens have no interior token; those (a stated set of patterns) are
    searched in every document, ``pattern_block`` at a time.
    """
    toks = items.select(F.col(qid).alias("qid"), F.col(qtext).alias("_qt"), F.posexplode(tokenize(F.col(qtext))).alias("pos", "term"))
    n_tok = toks.groupBy("qid").agg(F.max("pos").alias("last"))
    interior = toks.join(n_tok, "qid").filter((F.col("pos") > 0) & (F.col("pos") < F.col("last")))
    dft = index["terms_raw"].select("term", "df")
    # items of 3+ tokens: rarest interior token
    anchor = interior.join(dft, "term").groupBy("qid").agg(F.min_by("term", F.struct("df", "term")).alias("term"))
    anchor = stored(anchor, "anchors")  # one term an item
    n_blocks = anchor.count() // anchor_block + 1
    terms = index["documents"].select("did", F.explode("terms").alias("term"))
    cand = None
    for i in range(n_blocks):
        block = anchor if n_blocks == 1 else anchor.filter(F.pmod(F.xxhash64("qid"), F.lit(n_blocks)) == i)
        hits = terms.join(F.broadcast(block), "term").select("qid", "did")
        cand = hits if cand is None else cand.unionByName(hits)
    texts_q = items.select(F.col(qid).alias("qid"), F.col(qtext).alias("_qt"))
    texts_d = docs.select(F.col(did).alias("did"), F.col(dtext).alias("_dt"))
    long_hits = stored(cand, "candidates").join(texts_d, "did").join(texts_q, "qid").filter(F.instr("_dt", F.col("_qt")) > 0).select("qid", "did")
    short = items.select(F.col(qid).alias("qid"), F.col(qtext).alias("_qt")).join(n_tok, "qid", "left") \
        .filter(F.coalesce(F.col("last"), F.lit(-1)) < 2).select("qid", "_qt")
    short = stored(short, "short-items")
    out = long_hits
    blocks = -(-short.count() // pattern_block)  # none without short items
    for i in range(blocks):
        block = short.filter(F.pmod(F.xxhash64("qid", "_qt"), F.lit(blocks)) == i)
        out = out.unionByName(texts_d.join(F.broadcast(block), F.instr("_dt", F.col("_qt")) > 0).select("qid", "did"))
    return out


def save_ivf(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK9: write the IVF index clustered by cell (one folder per cell, rows
    sorted by id) so a probe prunes to its cells' files."""
    index.repartition("cell").sortWithinPartitions("cell", index.columns[0]).write.mode(mode).partitionBy("cell").parquet(path)


def nearest(corpus: DataFrame, vector: Sequence[float], k: int = 10, metric: str = "cosine", did: str = "did",
            dvec: str = "embedding") -> DataFrame:
    """SRT3: ``ORDER BY distance LIMIT k`` for one query vector (planned as
    TakeOrderedAndProject: a per-task top-k then a final merge), returning
    ``similarity = 1 - distance`` for cosine."""
    q = F.array(*[F.lit(float(x)) for x in vector])
    if metric == "cosine":
        dist = V.cosine_distance(dvec, q)
    elif metric in ("l2", "euclidean"):
        dist = V.euclidean(dvec, q)
    else:
        dist = -V.inner_product(dvec, q)
    return corpus.select(did, dist.alias("distance")).orderBy("distance", did).limit(k).withColumn(
        "similarity", F.lit(1.0) - F.col("distance"))


def sanity_cosine(queries: DataFrame, corpus: DataFrame, qrels: DataFrame, qid: str = "qid", did: str = "did",
                  vec: str = "embedding") -> DataFrame:
    """RET10: cosine of each query with each of its relevant documents (a check
    that ids and vectors are aligned)."""
    q = queries.select(F.col(qid).alias("qid"), F.col(vec).alias("_qv"))
    d = corpus.select(F.col(did).alias("did"), F.col(vec).alias("_dv"))
    return qrels.select("qid", "did").join(q, "qid").join(d, "did").select(
        "qid", "did", F.round(V.cosine("_qv", "_dv"), 6).alias("cosine"))


class Retriever:
    """UDF1: the retriever contract - ``search(queries, k) -> (qid, did,
    score, rank)``; implementations below wrap the jobs of this module."""

    def search(self, queries: DataFrame, k: int) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


class DenseRetriever(Retriever):
    def __init__(self, corpus: DataFrame, metric: str = "cosine"):
        self.corpus, self.metric = corpus, metric

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """UDF1 by exact dense search."""
        return exact_topk(queries, self.corpus, k, self.metric)


class BM25Retriever(Retriever):
    def __init__(self, corpus: DataFrame):
        self.corpus = corpus
        self.index = bm25_index(corpus)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """UDF1 by BM25."""
        return bm25_topk(queries, self.corpus, self.index, k)


class IVFIndex:
    """UDF2: the index contract - build once, search with a probe knob, report
    its footprint."""

    def __init__(self, centroids: DataFrame, metric: str = "cosine"):
        self.centroids, self.metric, self.index = centroids, metric, None

    def build(self, corpus: DataFrame, path: str | None = None) -> DataFrame:
        """UDF2: assign all vectors and store them by cell."""
        self.index = ivf_build(corpus, self.centroids, metric=self.metric)
        if path:
            save_ivf(self.index, path)
            self.index = corpus.sparkSession.read.parquet(path)
        else:
            self.index = stored(self.index, "ivf")
        return self.index

    def footprint(self) -> DataFrame:
        """Vectors and cells held."""
        return self.index.agg(F.count(F.lit(1)).alias("vectors"), F.count_distinct("cell").alias("cells"))

    def search(self, queries: DataFrame, k: int, nprobes: Sequence[int] = (1,)) -> DataFrame:
        return ivf_topk(queries, self.index, self.centroids, k, nprobes, metric=self.metric)
