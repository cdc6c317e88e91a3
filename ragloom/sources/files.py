"""File sources and sinks of the benchmark and document jobs (SRC1-SRC3, SRC5,
SRC8, SRC12, SNK1-SNK5, SNK12) and the input filters that go with them
(FIL1-FIL3, FIL5).

All readers use explicit schemas; file order, where the source depends on it,
becomes an explicit ``pos`` column: file path, offset of the read block in the
file, and a number that grows with the row inside the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import path_exists

CORPUS_SCHEMA = "_id string, text string"
QRELS_SCHEMA = "`query-id` string, `corpus-id` string, score int"


def file_position() -> Column:
    """Order of rows as in the files, files by path (read together with the
    rows, before any shuffle)."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


# ---------------------------------------------------------------------------
# SRC1 - SRC3, SRC5
# ---------------------------------------------------------------------------


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: JSONL ``{_id, text}`` -> ``(_id, text, pos)``; malformed lines are
    kept in ``_corrupt_record`` rather than failing the job."""
    df = (spark.read.schema(CORPUS_SCHEMA + ", _corrupt_record string").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return df.withColumn("pos", file_position())


def read_qrels(spark: SparkSession, path: str, positive_only: bool = True) -> DataFrame:
    """SRC2 / SRC3: tab-separated qrels with a header -> ``(qid, did, score,
    pos)``; only ``score > 0`` counts as relevant unless ``positive_only`` is
    off."""
    df = spark.read.schema(QRELS_SCHEMA).option("sep", "\t").option("header", True).csv(path)
    df = df.select(F.col("`query-id`").alias("qid"), F.col("`corpus-id`").alias("did"), "score", file_position().alias("pos"))
    return df.filter(F.col("score") > 0) if positive_only else df


def relevant_sets(qrels: DataFrame) -> DataFrame:
    """D2 set form ``(qid, relevant array<string>)``; one bounded list per query."""
    return qrels.groupBy("qid").agg(F.array_sort(F.collect_set("did")).alias("relevant"))


def candidate_pool(corpus: DataFrame, qrels: DataFrame, n_others: int) -> DataFrame:
    """SRC5: every relevant document plus the first ``n_others`` other
    documents in file order (the limit is the pool size, the feature)."""
    rel = qrels.select(F.col("did").alias("_id")).distinct()
    relevant = corpus.join(rel, "_id", "left_semi")
    others = corpus.join(rel, "_id", "left_anti").orderBy("pos").limit(n_others)
    return relevant.unionByName(others)


# ---------------------------------------------------------------------------
# FIL1 - FIL3, FIL5
# ---------------------------------------------------------------------------


def first_n_subset(corpus: DataFrame, qrels: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """FIL1: the first ``n`` documents in file order, qrels restricted to them,
    queries left without relevant documents dropped."""
    sub = corpus.orderBy("pos").limit(n)
    q = qrels.join(sub.select(F.col("_id").alias("did")), "did", "left_semi")
    return sub, q


def queries_with_qrels(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """FIL2: queries that have at least one relevant document."""
    return queries.join(qrels.select(F.col("qid").alias("_id")).distinct(), "_id", "left_semi")


def pick_eval_queries(queries: DataFrame, qrels: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """FIL3: the first ``n`` queries (by first qrels row) that exist and have a
    non-empty text, with their relevant ids; plus all relevant ids (SET4)."""
    first = qrels.groupBy("qid").agg(F.min("pos").alias("first_pos"), F.array_sort(F.collect_set("did")).alias("relevant_ids"))
    q = queries.filter(F.length(F.trim("text")) > 0).select(F.col("_id").alias("qid"), F.col("text").alias("query"))
    picked = first.join(q, "qid").orderBy("first_pos").limit(n).drop("first_pos")
    all_rel = picked.select(F.explode("relevant_ids").alias("did")).distinct()
    return picked, all_rel


def vector_contract(df: DataFrame, vec: str = "embedding", dim: int | None = None, eps: float = 1e-3,
                    id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """FIL5: split rows into valid vectors and a quarantine table with the
    first failed rule (null, wrong dimension, null component, not unit
    length)."""
    n = F.sqrt(F.aggregate(F.col(vec), F.lit(0.0).cast("double"),
                           lambda acc, x: acc + x.cast("double") * x.cast("double")))
    reason = (F.when(F.col(vec).isNull(), F.lit("null_vector"))
              .when(F.lit(dim is not None) & (F.size(vec) != F.lit(dim or 0)), F.lit("wrong_dimension"))
              .when(F.exists(vec, lambda x: x.isNull() | F.isnan(x)), F.lit("null_component"))
              .when(F.abs(n - 1.0) >= eps, F.lit("not_normalised")))
    if id_col is not None:
        reason = F.when(F.col(id_col).isNull(), F.lit("null_id")).otherwise(reason)
    tagged = df.withColumn("_reason", reason)
    return tagged.filter(F.col("_reason").isNull()).drop("_reason"), tagged.filter(F.col("_reason").isNotNull()) \
        .withColumnRenamed("_reason", "reason")


# ---------------------------------------------------------------------------
# SNK1 - SNK5
# ---------------------------------------------------------------------------


def write_corpus_files(corpus: DataFrame, queries: DataFrame, qrels: DataFrame, out: str,
                       force: bool = False) -> dict[str, int]:
    """SNK1 / SNK2: corpus and queries as JSONL, qrels as TSV with header;
    existing outputs are kept unless ``force``, with a count of -1. Row counts
    come from ``observe`` on the write itself."""
    spark = corpus.sparkSession
    counts = {}
    for name, df, fmt in [("corpus", corpus.select("_id", "text"), "json"), ("queries", queries.select("_id", "text"), "json"),
                          ("qrels", qrels, "csv")]:
        if not force and path_exists(spark, f"{out}/{name}"):
            counts[name] = -1
            continue
        obs = Observation(name)
        w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if fmt == "json":
            w.json(f"{out}/{name}")
        else:
            w.option("sep", "\t").option("header", True).csv(f"{out}/{name}")
        counts[name] = int(obs.get["n"])
    return counts


def write_parts(df: DataFrame, out: str, part_rows: int = 50_000, order: str = "pos") -> DataFrame:
    """SNK3: resumable chunked write. Rows get ``part_id = pos_rank //
    part_rows`` by ``order``, which must be unique (so that a resumed run deals
    the same rows to the same parts); parts already present under ``out`` are
    skipped (left anti on the listed part ids), the rest are appended; count
    and content hash of the final table are checked against the input. Returns
    the written table."""
    from ..operators.documents import content_hash
    from ..operators.common import global_row_number

    spark = df.sparkSession
    numbered = global_row_number(df, [order], "_rn").withColumn(
        "part_id", F.floor((F.col("_rn") - 1) / part_rows).cast("int")).drop("_rn")
    done = _existing_parts(spark, out)
    pending = numbered if done is None else numbered.join(done, "part_id", "left_anti")
    pending.write.mode("append").partitionBy("part_id").parquet(out)
    written = spark.read.parquet(out)
    state = [F.count(F.lit(1)).alias("n"), content_hash(df).alias("h")]
    n_in, n_out = df.agg(*state).first(), written.select(df.columns).agg(*state).first()
    if n_in != n_out:
        raise ValueError(f"chunked write has (rows, hash) {tuple(n_out)}, expected {tuple(n_in)}")
    return written


def _existing_parts(spark: SparkSession, out: str) -> DataFrame | None:
    return spark.read.parquet(out).select("part_id").distinct() if path_exists(spark, out) else None


def write_results(df: DataFrame, out: str, fields: Sequence[str], mode: str = "append") -> None:
    """SNK4: fixed column order, blanks for nulls, appended per configuration
    (a crash loses at most the configuration being written)."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields]
    df.select(*cols).write.mode(mode).option("header", True).option("emptyValue", "").option("nullValue", "").csv(out)


def append_results(old: DataFrame, new: DataFrame, out: str) -> DataFrame:
    """SNK5: union old and new rows by name (missing columns become null) and
    write them as a new version folder (a path is never overwritten while it
    is being read)."""
    merged = old.unionByName(new, allowMissingColumns=True)
    merged.write.mode("errorifexists").parquet(out)
    return merged.sparkSession.read.parquet(out)


def read_results(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """SRC12: result CSVs back with an explicit schema; missing optional files
    are skipped."""
    existing = [p for p in paths if path_exists(spark, p)]
    if not existing:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(existing)


def footprint(spark: SparkSession, path: str) -> DataFrame:
    """SNK12: files and bytes on disk under ``path`` (binaryFile without the
    content column: only file metadata is listed)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.round(F.sum("length") / (1 << 20), 3).alias("mb"))


def raw_vector_mb(df: DataFrame, vec: str = "embedding") -> Column:
    """SNK12: raw float32 size n*d*4 / 2^20 as an aggregate column."""
    return F.round(F.sum(F.size(vec)) * 4 / (1 << 20), 3)


# ---------------------------------------------------------------------------
# SRC8: sectioned benchmark log
# ---------------------------------------------------------------------------

# The three line kinds of the log.
SECTION_RE = r"^=== (.+?)(?:\s*\(.*\))? ===$"
INDEX_RE = r"index_time=([\d.]+)s\s+disk=([\d.]+)\s*MB"
PROBE_RE = r"ef=(\d+):\s+p50=([\d.]+)ms\s+p95=([\d.]+)ms\s+recall_qrels=([\d.]+)\s+recall_flat=([\d.]+)"


def parse_sectioned_log(lines: DataFrame, file: str = "file", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """SRC8 / WIN4: three line kinds -> one row per probe setting. The section name
    and the last index line are carried forward within each file
    (``last(..., ignorenulls)`` over the file's line order); the row name is
    the section name with ``(efS=<ef>)`` (an existing ``efS=`` is rewritten)."""
    l = lines.select(F.col(file).alias("file"), F.col(line_no).alias("line_no"), F.rtrim(F.col(line)).alias("line"))
    sec = F.regexp_extract("line", SECTION_RE, 1)
    l = l.withColumn("section", F.when(sec != "", F.trim(sec)))
    has_idx = F.col("line").rlike(INDEX_RE)
    l = l.withColumn("index_time", F.when(has_idx, F.regexp_extract("line", INDEX_RE, 1).cast("double")))
    l = l.withColumn("disk_mb", F.when(has_idx, F.regexp_extract("line", INDEX_RE, 2).cast("double")))
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    for c in ("section", "index_time", "disk_mb"):
        l = l.withColumn(c, F.last(c, ignorenulls=True).over(w))
    probe = l.filter(F.col("line").rlike(PROBE_RE) & F.col("section").isNotNull())
    ef = F.regexp_extract("line", PROBE_RE, 1)
    name = F.when(F.col("section").contains("efS="), F.regexp_replace("section", r"efS=\d+", F.concat(F.lit("efS="), ef))) \
        .otherwise(F.concat(F.col("section"), F.lit("(efS="), ef, F.lit(")")))
    g = lambda i: F.regexp_extract("line", PROBE_RE, i).cast("double")
    return probe.select("file", "line_no", name.alias("db"), "index_time", "disk_mb",
                        g(2).alias("latency_p50_ms"), g(3).alias("latency_p95_ms"),
                        g(4).alias("recall_qrels_at_10"), g(5).alias("recall_flat_at_10"))


# Result-name prefixes and the engine family they denote, in the
# order they are tested.
FAMILIES = ["FAISS-Flat", "FAISS-HNSW", "Chroma", "Qdrant", "pgvector"]


def family_of(name: Column, families=None) -> Column:
    """FIL16: engine family from a result name prefix ('other' otherwise)."""
    out = F.lit("other")
    for fam in reversed(families or FAMILIES):
        out = F.when(name.startswith(fam), F.lit(fam)).otherwise(out)
    return out


# ---------------------------------------------------------------------------
# SRC6 / SRC7 / SRC9: caption folders, raw files, gold labels
# ---------------------------------------------------------------------------


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core; Spark's default is a task per
    folder up to ten thousand."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_caption_files(spark: SparkSession, folder: str, ids: Sequence[str] | None = None, suffix: str = ".vtt",
                       name: str = r"([^/]+)$") -> DataFrame:
    """SRC6: every caption file under a folder (or only an allow-list of names;
    missing ones are simply absent) as numbered lines ``(file, line_no,
    line)``; one row per file is read whole, then split, so line order is kept
    without a global sort. ``name`` picks the file's name out of its path."""
    with _few_listing_tasks(spark):
        df = spark.read.option("wholetext", True).option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").text(folder)
    df = df.select(F.regexp_extract(F.col("_metadata.file_path"), name, 1).alias("file"), "value")
    if ids is not None:
        # the allow-list is given by the caller
        wanted = spark.createDataFrame([(n,) for i in ids for n in (str(i), f"{i}{suffix}")], "file string")
        df = df.join(F.broadcast(wanted), "file", "left_semi")
    return df.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def read_raw_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """SRC7: bytes with name, suffix and size (``binaryFile``)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("suffix"),
                     F.col("length").alias("size"), "content")


GOLD_SCHEMA = ("dataset string, tasks array<struct<owner:string,task_keywords:array<string>>>, valid_owners array<string>, "
               "decision_keywords array<array<string>>, decisions_count int")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: gold labels, one multi-line JSON document per dataset (files
    anywhere under ``path``)."""
    return spark.read.schema(GOLD_SCHEMA).option("multiLine", True).option("recursiveFileLookup", "true").json(path)
