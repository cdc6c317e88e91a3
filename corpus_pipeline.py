"""A corpus pipeline of five stages over ``documents``.

Every stage takes what its predecessor kept (written as Parquet and read again)
and returns the columns of ``documents``; the last one returns token digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.llm import decontamination, minhash_dedup, queries, secret_scan, sentencepiece_codec, toxicity
from ragloom.llm.session import prepare
from ragloom.session import ensure_checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic. The chain is
    fitted to the labelled documents among those of the stage's input. Null and
    empty texts have no features and get the chain's base rate; repeated rows
    are judged alike and all stay or all go; rows with a null id are judged but
    never learned from; an empty table gives an empty one."""
    prepare(spark)
    return toxicity.keep_clean(docs, queries.toxicity_chain(spark, docs, sf_dir))


def _free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no such column (in any case)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id.
    Rows that repeat an id and a text are one document, of which the smallest
    row (by its columns from left to right) stays; an id with different texts is
    as many documents. Rows with a null id belong to no class and all stay.
    Texts without words are near nothing but equal texts. An empty table gives an
    empty one; columns of any name are kept as they are."""
    prepare(spark)
    row = _free_name(docs, "_row")
    # whole-number ids in hexadecimal, in their order; then the text
    number = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    keyed = docs.withColumn(row, F.concat(number, *(F.lpad(F.hex(F.xxhash64(F.lit(k), "text")), 16, "0") for k in (1, 2))))
    classes = minhash_dedup.near_duplicates(keyed.select(row, "text"), id_col=row)
    kept = classes.where(F.col("kept") & F.col(row).isNotNull()).select(row)
    first = keyed.join(kept, row, "left_semi").groupBy(row).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_kept"))
    return first.select("_kept.*").unionAll(docs.where(F.col("doc_id").isNull()))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none and
    stay; every row is judged by its own text, so repeated rows share their fate
    and a null id changes nothing; an empty table, or an empty benchmark, gives
    the table back."""
    items = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.clean(docs, items)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; ``n_chars`` of a
    changed text is its new length. Null and empty texts, repeated rows and null
    ids stay as they are; an empty table gives an empty one."""
    prepare(spark)
    return secret_scan.redact_documents(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of all documents; the decoded text is compared
    with the text by its digest. One row per input row, repeated rows and null
    ids included; a null or empty text has the begin and end ids only; an empty
    table gives an empty one."""
    prepare(spark)
    return sentencepiece_codec.encode_decode(docs, queries.piece_model(), with_text=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash", minhash_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", sentencepiece_stage),
]

# The classifier and the signatures have no SQL; the tests compare every stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    prepare(spark)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
