"""Source divergence audit: how the vocabulary of every source differs from the
other sources of its language, and by which terms.

Every task runs an Arrow compute pipeline over its texts (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``) and keeps a
table of partial counts. The partial counts meet by language and term; what is
kept is stored as columns, dealt into shards of whole terms, and each shard adds
up the differences of all pairs of sources over its terms. All sums are whole
numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import stored

SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between terms, once A-Z is lower-cased
BLOCK_BYTES = 4 << 20
TABLE_ROWS = 600_000  # partial counts that a task holds before it gives them on
CELLS = 1 << 16  # sources times terms of a shard; with many sources more, so that it has about as many terms as sources
MOST_CELLS = 1 << 22
SMOOTHING = 5
SCALE = 1_000_000_000

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def block_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of a batch of
    ``lang, source, text``; a row with a null term for every (lang, source)."""
    lang, source = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
    wide = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), SEPARATOR)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.not_equal(flat, "")
    terms = flat.filter(some).dictionary_encode()
    in_docs = (pa.table([owner.filter(some), terms.indices, pa.array(np.ones(len(terms), dtype=np.int64))], ["doc", "term", "n"])
               .group_by(["doc", "term"], use_threads=False).aggregate([("n", "sum")]))
    counts = (pa.table([pa.array(group[in_docs.column("doc").to_numpy()]), in_docs.column("term"), in_docs.column("n_sum")], ["group", "term", "n"])
              .group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")]))
    present = np.unique(group)
    ids = np.concatenate([counts.column("group").to_numpy(), present])
    rows = len(present)
    return pa.table([
        lang.dictionary.take(pa.array(ids // wide if wide else ids)), source.dictionary.take(pa.array(ids % wide if wide else ids)),
        pa.concat_arrays([terms.dictionary.take(counts.column("term").combine_chunks()), pa.nulls(rows, pa.string())]),
        pa.concat_arrays([counts.column("n_sum").combine_chunks(), pa.array(np.zeros(rows, dtype=np.int64))]),
        pa.concat_arrays([counts.column("n_count").combine_chunks().cast(pa.int64()), pa.array(np.zeros(rows, dtype=np.int64))]),
    ], schema=_PARTIAL)


def _merged(tables: list[pa.Table]) -> pa.Table:
    added = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_PARTIAL.names).cast(_PARTIAL)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(size) - size) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:], strict=False):
        if j > i:
            yield batch.slice(i, j - i)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task, merged as long as they fit ``TABLE_ROWS``."""
    held: list[pa.Table] = []
    merged, fresh = 0, 0
    for batch in batches:
        for part in _blocks(batch):
            held.append(block_counts(part))
            fresh += held[-1].num_rows
            if fresh > max(merged, TABLE_ROWS // 4):
                held = [_merged(held)]
                merged, fresh = held[0].num_rows, 0
            if merged > TABLE_ROWS:
                yield from held[0].to_batches(max_chunksize=50_000)
                held, merged = [], 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=50_000)


def kept_counts(docs: DataFrame, min_docs: int, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n`` of the terms that at least ``min_docs``
    documents of their language hold, the language's count ``total`` of the
    term, ``first`` (1 on one row of each term of a language), and a row with a
    null term for every (lang, source). Stored in the shared folder."""
    text = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    partial = docs.select(*text).mapInArrow(count_terms, "lang string, source string, term string, n bigint, docs bigint")
    # one shuffle: rows of a language's term stay together for the sums and the windows
    sums = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = sums.select("lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("docs").over(term).alias("docs"),
                       (F.row_number().over(term.orderBy("source")) == 1).cast("bigint").alias("first"))
    return stored(rows.where(F.col("term").isNull() | (F.col("docs") >= min_docs)).drop("docs"), "kept-terms")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)) in exact decimals."""
    over = F.greatest(total + SMOOTHING * terms, F.lit(1)).cast("decimal(20,0)")
    scaled = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, over).cast("bigint") + 1


def shard_sums(table: pa.Table) -> pa.Table:
    """Sum of absolute differences of every two sources over the terms of one
    shard. Rows with a null term give each source's share of a term that it
    does not hold."""
    lang, shard = table.column("lang")[0], table.column("shard")[0]
    base = table.filter(pc.is_null(table.column("term"))).sort_by("source")
    names = base.column("source").combine_chunks()
    held = table.filter(pc.is_valid(table.column("term")))
    terms = held.column("term").combine_chunks().dictionary_encode()
    share = np.repeat(base.column("p").to_numpy()[:, None], len(terms.dictionary), axis=1)
    row = pc.index_in(held.column("source").combine_chunks(), value_set=names).to_numpy(zero_copy_only=False)
    share[row, terms.indices.to_numpy()] = held.column("p").to_numpy()
    sums = [np.abs(share[i + 1:] - share[i]).sum(axis=1) for i in range(len(names))]
    n = len(names)
    a, b = np.repeat(np.arange(n), np.arange(n)[::-1]), np.concatenate([np.arange(i + 1, n) for i in range(n)])
    rows = len(a)
    return pa.table([pa.repeat(lang, rows), names.take(pa.array(a)), names.take(pa.array(b.astype(np.int64))),
                     pa.array(np.concatenate(sums).astype(np.int64)), pa.repeat(shard, rows)], ["lang", "a", "b", "value", "shard"])


def audit(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Divergences of every (lang, source) group.

    A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased;
    a language keeps the terms that at least ``min_docs`` of its documents hold.
    Returns ``lang, source, part, item, value, rank``: in part ``pair`` every
    other source of the language with the sum of the absolute differences of all
    kept terms' smoothed shares (parts of 10^9, rounded down); in part ``term``
    the ``top_terms`` terms whose share in the group lies furthest above their
    share in the language. Larger values come first, ties by the item's bytes.

    Null language, source and text count as empty strings, which are a language
    and a source of their own. Repeated rows are documents each. Groups without
    terms take part in the pairs; a language without kept terms gives zeros, and
    a language with one source no pairs. An empty table gives an empty one;
    other columns are not read. A very long text is counted whole, as a block of
    its own. A hot source is counted in its tasks before anything is shuffled;
    windows see one row per source, or the ``top_terms`` of a task.
    """
    kept = kept_counts(docs, min_docs, lang_col, source_col, text_col)
    lang = Window.partitionBy("lang")
    groups = stored(
        kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum(F.when(F.col("term").isNotNull(), F.col("first")).otherwise(0)).alias("own"))
        .select("lang", "source", "size", F.sum("own").over(lang).alias("terms"), F.sum("size").over(lang).alias("lang_size"),
                F.count(F.lit(1)).over(lang).alias("sources"))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / F.greatest(F.lit(CELLS), F.least(F.col("sources") * F.col("sources"), F.lit(MOST_CELLS))))).cast("bigint")), "source-groups")
    counts = (kept.where(F.col("term").isNotNull()).join(groups, ["lang", "source"])
              .withColumn("p", _share(F.col("n"), F.col("size"), F.col("terms"))))

    above = F.col("p") - _share(F.col("total"), F.col("lang_size"), F.col("terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (counts.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value")).where(F.col("value") > 0)
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms))

    dealt = counts.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"), "source", "term", "p")
    absent = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"), "source", F.lit(None).cast("string").alias("term"),
                           _share(F.lit(0).cast("bigint"), F.col("size"), F.col("terms")).alias("p"))
    sums = (dealt.unionByName(absent).groupBy("lang", "shard").applyInArrow(shard_sums, "lang string, a string, b string, value bigint, shard bigint")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pairs = (both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(terms)
