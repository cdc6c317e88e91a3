"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontamination,
    embedding_dedup,
    hard_negatives,
    minhash_dedup,
    quality,
    secret_scan,
    sentencepiece_codec,
    sharding,
    source_divergence,
    speculative_bpe,
    toxicity,
    url_filter,
)
from .session import prepare

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> bytes:
    """The bytes of the public tokenizer that the query names."""
    import public_tokenizers

    return sentencepiece_codec.read_model(public_tokenizers.path(PIECE_MODEL))


def word_tokenizer() -> str:
    """The text of the public tokenizer file that the query names."""
    import public_tokenizers

    return speculative_bpe.read_tokenizer(public_tokenizers.path(WORD_MODEL))


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` url judged by rules, else by the n-gram model."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


@_query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal ``conversations``, rendered."""
    return chat_format.format_conversations(_table(spark, sf_dir, "conversations"))


SQL["op2_chat_formatting"] = r"""
WITH talks AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
         list(struct_pack(r := role, t := text) ORDER BY turn) AS turns
  FROM conversations GROUP BY conv_id),
once AS (
  SELECT min(conv_id) AS conv_id, n_turns, turns, CAST(count(*) AS BIGINT) AS copies
  FROM talks GROUP BY n_turns, turns),
inner_prefixes AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM once))
SELECT conv_id, 0 AS part, n_turns, copies,
       array_to_string(list_transform(turns, lambda x: '<|im_start|>' || replace(coalesce(x.r, ''), '<|im_', '<| im_') || chr(10)
         || replace(coalesce(x.t, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10)), '') AS rendered
FROM once WHERE turns NOT IN (SELECT turns FROM inner_prefixes)
"""


@_query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23 of nearly equal bytes."""
    placed, _ = sharding.shard(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all ``documents`` that are ``benchmark`` items."""
    return decontamination.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


@_query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more between all ``embeddings``."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded."""
    return sentencepiece_codec.encode_decode(_table(spark, sf_dir, "documents"), piece_model(), with_ids=False, with_text=False)


# Words by which a document labelled toxic is put into a category as well.
CATEGORY_WORDS = {
    "insult": "clown idiot loser moron stupid".split(),
    "contempt": "disgusting pathetic scum trash worthless".split(),
}
LABELLED_ROWS = 8_000


QUALITY_ROWS = 6_000


def quality_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, label: str, rows: int, mod_rest: bool = False) -> DataFrame:
    """A bounded sample of the labelled ``docs``: those of the ``rows`` ids with
    the smallest hashes. The sampled ids (at most ``rows``) are broadcast."""
    labels = _table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if mod_rest:
        labels = labels.where(~quality_held_out(F.col("doc_id")))
    ids = labels.groupBy("doc_id").agg(F.max(label).alias(label)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def toxicity_chain(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Chain:
    """The chain insult, contempt, toxic, fitted to a sample of ``labels``."""
    rows = labelled_documents(spark, docs, sf_dir, "toxic", LABELLED_ROWS)
    for name, words in CATEGORY_WORDS.items():
        said = F.coalesce(F.col("text"), F.lit("")).rlike(rf"(?i)\b({'|'.join(words)})\b")
        rows = rows.withColumn(name, ((F.col("toxic") == 1) & said).cast("int"))
    return toxicity.fit_chain(rows, [*CATEGORY_WORDS, "toxic"], settings=toxicity.ChainSettings(rows=LABELLED_ROWS))


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities of all ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity_chain(spark, docs, sf_dir))


@_query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    rows = labelled_documents(spark, docs, sf_dir, "quality", QUALITY_ROWS, mod_rest=True)
    network = quality.fit(rows, "quality", settings=quality.QualitySettings(rows=QUALITY_ROWS), docs=docs)
    return quality.score(docs, network).select(
        "doc_id", F.coalesce(quality_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every (lang, source) of ``documents``, by terms in at
    least 30 documents of the language."""
    return source_divergence.audit(_table(spark, sf_dir, "documents"))


SQL["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
held AS (
  SELECT r, lang, source, term, count(*) AS n FROM (
    SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM held GROUP BY lang, term HAVING count(*) >= 30),
langs AS (
  SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS size FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, sum(held.n) AS n FROM held JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (
  SELECT lang, source, any_value(v) AS v, any_value(size) AS lang_size, coalesce(sum(n), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM d) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * CAST(coalesce(c.n, 0) + 5 AS HUGEINT)) // (g.size + 5 * g.v) AS p,
         1 + (1000000000 * CAST(k.n + 5 AS HUGEINT)) // (g.lang_size + 5 * g.v) AS q
  FROM grp g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) <= 50
"""


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors of ``embeddings``; rows whose id is
    divisible by 7 have the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), label=label)


SQL["op12_hard_negatives"] = r"""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id AND len(a.v) = len(r.v) WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
"""


@_query
def op13_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded."""
    return speculative_bpe.encode_decode(_table(spark, sf_dir, "documents"), word_tokenizer(), with_ids=False, with_text=False)
