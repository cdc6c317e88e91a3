"""Registered file sources and sinks: every query writes a test table to the
shared scratch folder through a library sink and reads it back through a
library source; the twin states the expected rows from the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..operators import evals as E
from ..operators import metrics as M
from ..operators import retrieval as R
from ..session import scratch_path
from ..sources import files as SF
from ..sources.tables import embeddings, table
from ..streaming import jobs as S
from .documents import SQL_CAPTIONS, SQL_DIRTY, caption_lines, clean_v2, dirty_orders
from .evals import SQL_EXTRACTION, extraction_inputs
from .registry import register


def fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"files/{name}-{uuid.uuid4().hex}")


def named_folder_text(df: DataFrame, path: str, folder: str) -> None:
    """One text file per value of ``folder`` (its rows' ``value`` texts)."""
    df.select(folder, "value").repartition(folder).write.partitionBy(folder).text(path)


# ---------------------------------------------------------------------------
# Corpus, queries and qrels files
# ---------------------------------------------------------------------------

N_QUERIES = 50
FIRST_N = 200
POOL_OTHERS = 100
PICKED = 10


def retrieval_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stand-in corpus (documents), queries (benchmark items) and qrels (labels:
    document d is judged for query d % 50, relevant when toxic), in id order; the
    number of parts follows the session's shuffle partitions and the data."""
    ordered = lambda df, key: df.repartitionByRange(key).sortWithinPartitions(key)
    docs = ordered(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    corpus = docs.select(F.col("doc_id").cast("string").alias("_id"), "text")
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("_id"), "text")
    lab = ordered(table(spark, sf, "labels"), "doc_id")
    qrels = lab.select(F.concat(F.lit("q"), (F.col("doc_id") % N_QUERIES).cast("string")).alias("query-id"),
                       F.col("doc_id").cast("string").alias("corpus-id"), F.col("toxic").alias("score"))
    return corpus, items, qrels


def retrieval_files(spark: SparkSession, sf: str) -> str:
    out = fresh(spark, "corpus")
    SF.write_corpus_files(*retrieval_tables(spark, sf), out)
    return out


SQL_QRELS_FILE = f"""
qrels AS (SELECT 'q' || (doc_id % {N_QUERIES}) AS qid, CAST(doc_id AS VARCHAR) AS did, toxic AS score, doc_id AS pos FROM labels),
pos_qrels AS (SELECT * FROM qrels WHERE score > 0)
"""


@register("corpus_files", sql="""
SELECT CAST(doc_id AS VARCHAR) AS _id, length(text) AS n_chars, md5(text) AS text_md5, true AS kept,
       (SELECT count(*) FROM documents) AS written FROM documents""", ops="SNK1 SNK2 SRC1")
def corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    """Write corpus, queries and qrels; a second write keeps the files; read
    the corpus back."""
    tables = retrieval_tables(spark, sf)
    out = fresh(spark, "corpus")
    first = SF.write_corpus_files(*tables, out)
    second = SF.write_corpus_files(tables[0].filter(F.lit(False)), *tables[1:], out)
    c = SF.read_corpus(spark, f"{out}/corpus").filter(F.col("_corrupt_record").isNull())
    return c.select("_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"),
                    F.lit(set(second.values()) == {-1}).alias("kept"), F.lit(first["corpus"]).cast("bigint").alias("written"))


@register("qrels_files", sql=f"""WITH {SQL_QRELS_FILE}
SELECT 'all' AS kind, qid, did, score FROM qrels UNION ALL SELECT 'relevant', qid, did, score FROM pos_qrels""", ops="SRC2 SRC3")
def qrels_files(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{retrieval_files(spark, sf)}/qrels"
    every = SF.read_qrels(spark, path, positive_only=False).select(F.lit("all").alias("kind"), "qid", "did", "score")
    return every.unionByName(SF.read_qrels(spark, path).select(F.lit("relevant").alias("kind"), "qid", "did", "score"))


@register("candidate_pool", sql=f"""WITH {SQL_QRELS_FILE},
rel AS (SELECT DISTINCT did FROM pos_qrels),
others AS (SELECT doc_id FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT did FROM rel) ORDER BY doc_id LIMIT {POOL_OTHERS})
SELECT CAST(doc_id AS VARCHAR) AS _id, md5(text) AS text_md5 FROM documents
WHERE doc_id IN (SELECT doc_id FROM others) OR CAST(doc_id AS VARCHAR) IN (SELECT did FROM rel)""", ops="SRC5 SRC1")
def candidate_pool(spark: SparkSession, sf: str) -> DataFrame:
    out = retrieval_files(spark, sf)
    pool = SF.candidate_pool(SF.read_corpus(spark, f"{out}/corpus"), SF.read_qrels(spark, f"{out}/qrels"), POOL_OTHERS)
    return pool.select("_id", F.md5("text").alias("text_md5"))


@register("first_n_subset", sql=f"""WITH {SQL_QRELS_FILE},
sub AS (SELECT CAST(doc_id AS VARCHAR) AS did FROM documents ORDER BY doc_id LIMIT {FIRST_N})
SELECT qid, count(*) AS n_relevant FROM pos_qrels WHERE did IN (SELECT did FROM sub) GROUP BY qid""", ops="FIL1")
def first_n_subset(spark: SparkSession, sf: str) -> DataFrame:
    out = retrieval_files(spark, sf)
    _, q = SF.first_n_subset(SF.read_corpus(spark, f"{out}/corpus"), SF.read_qrels(spark, f"{out}/qrels"), FIRST_N)
    return q.groupBy("qid").agg(F.count(F.lit(1)).alias("n_relevant"))


def _queries(spark: SparkSession, out: str) -> DataFrame:
    return SF.read_corpus(spark, f"{out}/queries").select("_id", "text")


@register("queries_with_qrels", sql=f"""WITH {SQL_QRELS_FILE}
SELECT 'q' || item_id AS _id, text FROM benchmark WHERE 'q' || item_id IN (SELECT qid FROM pos_qrels)""", ops="FIL2")
def queries_with_qrels(spark: SparkSession, sf: str) -> DataFrame:
    out = retrieval_files(spark, sf)
    return SF.queries_with_qrels(_queries(spark, out), SF.read_qrels(spark, f"{out}/qrels"))


SQL_PICKED = f"""{SQL_QRELS_FILE},
picked AS (
  SELECT p.qid, b.text AS query, list_sort(list(DISTINCT p.did)) AS relevant, min(p.pos) AS first_pos
  FROM pos_qrels p JOIN benchmark b ON 'q' || b.item_id = p.qid WHERE length(trim(b.text)) > 0
  GROUP BY p.qid, b.text ORDER BY first_pos LIMIT {PICKED})
"""


@register("eval_queries", sql=f"WITH {SQL_PICKED} SELECT qid, query, array_to_string(relevant, ' ') AS relevant FROM picked", ops="FIL3 SRC2")
def eval_queries(spark: SparkSession, sf: str) -> DataFrame:
    out = retrieval_files(spark, sf)
    picked, _ = SF.pick_eval_queries(_queries(spark, out), SF.read_qrels(spark, f"{out}/qrels"), PICKED)
    return picked.select("qid", "query", F.array_join("relevant_ids", " ").alias("relevant"))


@register("eval_relevant_ids", sql=f"WITH {SQL_PICKED} SELECT DISTINCT unnest(relevant) AS did FROM picked", ops="SET4 FIL3")
def eval_relevant_ids(spark: SparkSession, sf: str) -> DataFrame:
    out = retrieval_files(spark, sf)
    return SF.pick_eval_queries(_queries(spark, out), SF.read_qrels(spark, f"{out}/qrels"), PICKED)[1]


# ---------------------------------------------------------------------------
# Vector contract, footprint
# ---------------------------------------------------------------------------


@register("vector_contract", sql="""
WITH d AS (
  SELECT CASE WHEN vec_id % 10 = 5 THEN NULL ELSE vec_id END AS vec_id, vec_id AS key,
         CASE vec_id % 10 WHEN 1 THEN NULL WHEN 2 THEN embedding[1:63]
              WHEN 3 THEN list_append(embedding[1:63], NULL) WHEN 4 THEN list_transform(embedding, lambda x: CAST(x * 2 AS FLOAT))
              ELSE embedding END AS v FROM embeddings)
SELECT key, CASE WHEN vec_id IS NULL THEN 'null_id' WHEN v IS NULL THEN 'null_vector' WHEN len(v) <> 64 THEN 'wrong_dimension'
                 WHEN len(list_filter(v, lambda x: x IS NULL)) > 0 THEN 'null_component'
                 WHEN abs(sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) - 1.0) >= 1e-3 THEN 'not_normalised'
                 ELSE 'ok' END AS reason FROM d""", ops="FIL5")
def vector_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty copies of every vector by id, checked against the contract."""
    e = embeddings(spark, sf)
    k, v = F.col("vec_id") % 10, F.col("embedding")
    dirty = (F.when(k == 1, F.lit(None).cast("array<float>")).when(k == 2, F.slice(v, 1, 63))
             .when(k == 3, F.concat(F.slice(v, 1, 63), F.array(F.lit(None).cast("float"))))
             .when(k == 4, F.transform(v, lambda x: (x * 2).cast("float"))).otherwise(v))
    d = e.select(F.when(k != 5, F.col("vec_id")).alias("vec_id"), F.col("vec_id").alias("key"), dirty.alias("embedding"))
    good, bad = SF.vector_contract(d, dim=64, id_col="vec_id")
    return good.select("key", F.lit("ok").alias("reason")).unionByName(bad.select("key", "reason"))


@register("index_footprint", sql="""
SELECT round(sum(len(embedding)) * 4 / 1048576, 3) AS raw_mb, true AS has_files, count(*) AS vectors FROM embeddings""", ops="SNK12")
def index_footprint(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors written and measured on disk, beside their raw size."""
    path = fresh(spark, "vectors")
    embeddings(spark, sf).write.parquet(path)
    disk = SF.footprint(spark, path).select(((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))
    raw = spark.read.parquet(path).agg(SF.raw_vector_mb(F.col("embedding")).alias("raw_mb"), F.count(F.lit(1)).alias("vectors"))
    return raw.join(disk, F.lit(True))  # one row each


# ---------------------------------------------------------------------------
# Resumable parts, result tables, versions
# ---------------------------------------------------------------------------

PART_ROWS = 300


@register("resumable_parts", sql=f"""
WITH p AS (SELECT doc_id, n_chars, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {PART_ROWS}) AS INTEGER) AS part_id FROM documents)
SELECT part_id, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(sum(n_chars) AS BIGINT) AS chars
FROM p GROUP BY part_id""", ops="SNK3")
def resumable_parts(spark: SparkSession, sf: str) -> DataFrame:
    """A run that stopped after two parts, then the whole run: parts present
    are kept, the rest is added."""
    df = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    out = fresh(spark, "parts")
    SF.write_parts(df.orderBy("doc_id").limit(2 * PART_ROWS), out, PART_ROWS, "doc_id")
    w = SF.write_parts(df, out, PART_ROWS, "doc_id")
    return w.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                                    F.sum("n_chars").cast("bigint").alias("chars"))


RESULT_FIELDS = ["config", "source", "n", "mean_chars", "note"]


@register("result_tables", sql="""
WITH r AS (SELECT lang AS config, source, count(*) AS n, round(avg(n_chars), 2) AS mean_chars FROM documents WHERE lang IN ('en', 'fr') GROUP BY ALL)
SELECT config, source, n, mean_chars, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS version FROM r
UNION ALL SELECT 'all', source, count(*), round(avg(n_chars), 2), NULL, 2 FROM documents GROUP BY source""", ops="SNK4 SNK5 SRC12")
def result_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Results appended per configuration as CSV, read back (a missing file is
    skipped), and merged with a new version that has one more column."""
    docs = table(spark, sf, "documents")
    per = lambda d, c: d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 2).alias("mean_chars")).withColumn("config", F.lit(c))
    out = fresh(spark, "results")
    for lang in ("en", "fr"):
        SF.write_results(per(docs.filter(F.col("lang") == lang), lang), out, RESULT_FIELDS)
    old = SF.read_results(spark, [out, f"{out}-missing"], "config string, source string, n bigint, mean_chars double, note string")
    new = per(docs, "all").withColumn("version", F.lit(2))
    return SF.append_results(old, new, f"{out}-merged")


@register("version_switch", sql=f"""WITH {SQL_DIRTY}
SELECT 'v1' AS version, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM v1
UNION ALL SELECT 'v2', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM v2""", ops="TXT12")
def version_switch(spark: SparkSession, sf: str) -> DataFrame:
    """Two committed versions of the orders, each switched to and counted; the
    manifests agree with what is read."""
    root = fresh(spark, "versions")
    out = None
    for tag, df in (("v1", dirty_orders(spark, sf).drop("pos")), ("v2", clean_v2(spark, sf))):
        manifest = D.commit_version(df, root, tag)
        back = D.read_version(spark, root, tag).agg(F.sum("o_orderkey").cast("bigint").alias("keys"))
        row = manifest.join(back, F.lit(True)).select("version", F.col("rows").cast("bigint").alias("n"), "keys")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------------------
# Raw files, arrivals, captions, logs, gold labels
# ---------------------------------------------------------------------------

PAGES_PER_FILE = 20
SQL_PAGE_FILES = f"""
f AS (SELECT page_id % ((SELECT count(*) FROM pages) // {PAGES_PER_FILE} + 1) AS folder, html FROM pages)
"""


def page_files(spark: SparkSession, sf: str) -> str:
    """Stand-in uploads: the pages as text files of about twenty pages."""
    p = table(spark, sf, "pages")
    path = f"{fresh(spark, 'arrivals')}/uploads"
    named_folder_text(p.select((F.col("page_id") % F.lit(p.count() // PAGES_PER_FILE + 1)).alias("folder"), F.col("html").alias("value")), path, "folder")
    return path


@register("raw_files", sql=f"""WITH {SQL_PAGE_FILES}
SELECT CAST(folder AS BIGINT) AS folder, 'txt' AS suffix, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS size FROM f GROUP BY folder""", ops="SRC7")
def raw_files(spark: SparkSession, sf: str) -> DataFrame:
    files = SF.read_raw_files(spark, page_files(spark, sf), "*.txt")
    return files.select(F.regexp_extract("path", r"folder=(\d+)/", 1).cast("bigint").alias("folder"), "suffix", F.col("size").cast("bigint").alias("size"))


@register("arrival_stream", sql=f"""WITH {SQL_PAGE_FILES}
SELECT CAST(folder AS BIGINT) AS folder, 'utf-8' AS encoding, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS length,
       CAST(sum(length(html) + 1) AS BIGINT) AS char_count, true AS moved FROM f GROUP BY folder""", ops="STR7 SRC11 SNK8 TXT13 TXT1")
def arrival_stream(spark: SparkSession, sf: str) -> DataFrame:
    """TXT13: arriving files as a stream, decoded, under their processed keys."""
    arrived = S.file_arrivals(spark, page_files(spark, sf), "*.txt")
    texts = D.decode_files(arrived).select("path", S.processed_key().alias("key"), "encoding", "length", "char_count")
    done = spark.read.parquet(S.run_to_table(texts, "arrivals"))
    return done.select(F.regexp_extract("path", r"folder=(\d+)/", 1).cast("bigint").alias("folder"), "encoding", "length",
                       F.col("char_count").cast("bigint").alias("char_count"),
                       (F.col("key") == F.replace(F.col("path"), F.lit("/uploads/"), F.lit("/processed/"))).alias("moved"))


@register("caption_files", sql=f"""WITH {SQL_CAPTIONS}
SELECT CAST(file AS VARCHAR) AS file, text, length(text) AS n_chars FROM captions""", ops="SRC6 TXT6 FUN2 FUN3 WIN3")
def caption_files(spark: SparkSession, sf: str) -> DataFrame:
    """Caption files written one per conversation, read line by line, cleaned."""
    path = fresh(spark, "captions")
    lines = caption_lines(spark, sf).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
    named_folder_text(lines.select("file", F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("value")), path, "file")
    return D.clean_captions(SF.read_caption_files(spark, path, suffix=".txt", name=r"file=([^/]+)/"))


SQL_LOG_DAYS = """
day AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1),
kind AS (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS c, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_type) AS k
         FROM events GROUP BY 1, 2)
"""


@register("sectioned_log", sql=f"""WITH {SQL_LOG_DAYS}
SELECT 'week-' || week(d) AS file, 'DB-' || strftime(d, '%Y-%m-%d') || '(efS=' || (16 * k) || ')' AS db, CAST(n AS DOUBLE) AS index_time,
       CAST(n * 2 AS DOUBLE) AS disk_mb, CAST(c AS DOUBLE) AS latency_p50_ms, CAST(c * 2 AS DOUBLE) AS latency_p95_ms,
       CAST('0.' || lpad(CAST(c % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS recall_qrels_at_10,
       CAST('0.9' || (c % 10) AS DOUBLE) AS recall_flat_at_10
FROM kind JOIN day USING (d)""", ops="SRC8 WIN4")
def sectioned_log(spark: SparkSession, sf: str) -> DataFrame:
    """A benchmark log per week (a section per day, an index line, a probe line
    per event type), written as text, read line by line and parsed."""
    ev = table(spark, sf, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("d"), "event_type")
    s = lambda c: c.cast("string")
    per = ev.groupBy("d", "event_type").agg(F.count(F.lit(1)).alias("c"))
    days = per.groupBy("d").agg(F.sum("c").alias("n"), F.sort_array(F.collect_list(F.struct("event_type", "c"))).alias("t"))  # one row a type
    probe = F.transform("t", lambda x, i: F.concat(
        F.lit("ef="), s((i + 1) * 16), F.lit(": p50="), s(x["c"]), F.lit("ms p95="), s(x["c"] * 2), F.lit("ms recall_qrels=0."),
        F.lpad(s(x["c"] % 1000), 3, "0"), F.lit(" recall_flat=0.9"), s(x["c"] % 10)))
    head = F.concat(F.lit("=== DB-"), F.date_format("d", "yyyy-MM-dd"), F.lit(" (n="), s(F.col("n")), F.lit(") ==="))
    index = F.concat(F.lit("index_time="), s(F.col("n")), F.lit("s  disk="), s(F.col("n") * 2), F.lit(" MB"))
    part = days.select(F.concat(F.lit("week-"), s(F.weekofyear("d"))).alias("file"), "d",
                       F.array_join(F.concat(F.array(head, index), probe), "\n").alias("value"))
    whole = part.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("d", "value"))).alias("_v"))  # a week has seven
    path = fresh(spark, "logs")
    named_folder_text(whole.select("file", F.array_join(F.transform("_v", lambda x: x["value"]), "\n").alias("value")), path, "file")
    return SF.parse_sectioned_log(SF.read_caption_files(spark, path, suffix=".txt", name=r"file=([^/]+)/")).drop("line_no")


@register("gold_files", sql=f"""WITH {SQL_EXTRACTION}
SELECT CAST(dataset AS VARCHAR) AS dataset, CAST(len(tasks) AS INTEGER) AS tasks, 3 AS owners, CAST(len(decision_keywords) AS INTEGER) AS decisions,
       decisions_count FROM gold""", ops="SRC9")
def gold_files(spark: SparkSession, sf: str) -> DataFrame:
    _, gold = extraction_inputs(spark, sf)
    path = fresh(spark, "gold")
    doc = F.to_json(F.struct(F.col("dataset").cast("string").alias("dataset"), *[c for c in gold.columns if c != "dataset"]))
    named_folder_text(gold.select(F.col("dataset").alias("folder"), doc.alias("value")), path, "folder")
    return SF.read_gold(spark, path).select("dataset", F.size("tasks").alias("tasks"), F.size("valid_owners").alias("owners"),
                                            F.size("decision_keywords").alias("decisions"), "decisions_count")


@register("result_records", sql=f"""WITH {SQL_EXTRACTION}
SELECT dataset, provider, valid_json, tasks_found, tasks_total, decisions_found, NOT valid_json AS keeps_raw FROM scores""", ops="SNK11 LLM8")
def result_records(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document per output, written as lines and read back."""
    outs, gold = extraction_inputs(spark, sf)
    path = fresh(spark, "records")
    E.result_records(E.extraction_eval(outs, gold), outs).select(F.to_json(F.struct("dataset", "provider", "record")).alias("value")).write.text(path)
    r = spark.read.schema("dataset bigint, provider string, record string").json(path)
    n = lambda k: F.get_json_object("record", f"$.metrics.{k}").cast("bigint").alias(k)
    return r.select("dataset", "provider", F.get_json_object("record", "$.meta.valid_json").cast("boolean").alias("valid_json"),
                    n("tasks_found"), n("tasks_total"), n("decisions_found"), F.get_json_object("record", "$.raw").isNotNull().alias("keeps_raw"))


# ---------------------------------------------------------------------------
# Bulk vector load, families of results
# ---------------------------------------------------------------------------


@register("max_per_family", sql="""
WITH r AS (SELECT CASE user_id % 6 WHEN 0 THEN 'FAISS-Flat' WHEN 1 THEN 'FAISS-HNSW' WHEN 2 THEN 'Chroma' WHEN 3 THEN 'Qdrant'
                       WHEN 4 THEN 'pgvector' ELSE 'other' END AS family, value FROM events)
SELECT family, max(value) AS max_value FROM r GROUP BY family""", ops="AGG27 FIL16")
def max_per_family(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(f) for f in [*SF.FAMILIES, "plain"]])
    r = table(spark, sf, "events").select(
        F.concat(F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")), F.lit("(efS=64)")).alias("name"), "value")
    return M.max_per_family(r.withColumn("family", SF.family_of(F.col("name"))), "family", "value")


@register("bulk_vector_load", sql="""
WITH d AS (SELECT vec_id, vec_id % 16 + 1 AS cell FROM embeddings)
SELECT CAST(cell AS INTEGER) AS cell, count(*) AS vectors, min(vec_id) AS first_id FROM d GROUP BY cell""", ops="SNK9")
def bulk_vector_load(spark: SparkSession, sf: str) -> DataFrame:
    """Drop and reload of a vector store laid out by cell."""
    path = fresh(spark, "store")
    e = embeddings(spark, sf).select("vec_id", "embedding", (F.col("vec_id") % 16 + 1).cast("int").alias("cell"))
    R.save_ivf(e.limit(0), path)
    R.save_ivf(e, path)
    return spark.read.parquet(path).groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"), F.min("vec_id").alias("first_id"))
