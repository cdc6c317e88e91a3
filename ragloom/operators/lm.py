"""Character language-model statistics (AGG20, FUN21, WIN8, TXT14, ML3, ML15,
ML16, FUN15): vocabulary, next-character counts, cross-entropy and the
temperature x top-k reshaping of next-character distributions.

The reference trains a small transformer; the Spark version keeps its data
work: vocabulary, positional 90/10 split, (char, next) counts with add-one
smoothing, loss on the held-out tail, and sampling-time reshaping.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


PAIR_CHARS = 1 << 19  # characters whose pairs are counted at a time


def chars(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per character with its position: ``(id, pos, ch, n)``."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    d = d.select("id", F.length("t").alias("n"), F.posexplode(F.split("t", "")).alias("pos", "ch"))
    return d.filter(F.length("ch") > 0)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """AGG20: sorted distinct characters -> dense 0-based ids. A task gathers
    the characters of its texts and emits each once (at most one per code
    point), without a row per character; the id is a row number over the
    (small) distinct set."""
    import pyarrow as pa

    def fn(batches):
        seen = set()
        for b in batches:
            for value in b.column(0):
                seen.update(value.as_py() or "")
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["ch"])

    from .common import ensure_parallel

    v = ensure_parallel(docs.select(text)).mapInArrow(fn, "ch string").distinct()
    return v.select("ch", (F.row_number().over(Window.orderBy("ch")) - 1).alias("id"))


def _in_id_order(vocab: DataFrame) -> list[str]:
    """The characters of a vocabulary (at most one per code point) in id order."""
    return vocab.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "ch"))), lambda x: x["ch"])).first()[0]


def _row_groups(sizes, limit: int = PAIR_CHARS) -> Iterator[tuple[int, int]]:
    """``(start, rows)`` of consecutive rows with about ``limit`` characters together."""
    start, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= limit:
            yield start, i + 1 - start
            start, n = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes) - start


def _lists(values, row, nulls):
    """Lists from flat ``values`` whose rows are ``row`` (ascending), null where ``nulls``."""
    import numpy as np
    import pyarrow as pa

    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(nulls)))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(nulls))


def encode(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """FUN21: characters -> ids in order (unknown characters dropped, as when
    serving); one array per document, made where its row lies. The vocabulary
    (at most one entry per code point) is shipped to the tasks, a character's id
    is its place there, and the code points of some thousand texts are looked up
    at once (``PAIR_CHARS`` characters and the longest text are held)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    codes = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    alphabet = docs.sparkSession.sparkContext.broadcast("".join(_in_id_order(vocab)))

    def fn(batches):
        known = codes(alphabet.value)
        place = np.full(0x110000, -1, dtype=np.int32)
        place[known[::-1]] = np.arange(len(known), dtype=np.int32)[::-1]  # the first place counts
        for b in batches:
            size = pc.fill_null(pc.utf8_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            for at, n in _row_groups(size.tolist()):
                part = b.slice(at, n)
                ids = place[codes("".join(t or "" for t in part.column(1).to_pylist()))]
                row = np.repeat(np.arange(n), size[at:at + n])
                lists = _lists(pa.array(ids[ids >= 0], pa.int32()), row[ids >= 0], part.column(1).is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    from .common import ensure_parallel

    kind = docs.schema[id_col].dataType.simpleString()
    return ensure_parallel(docs.select(id_col, text)).mapInArrow(fn, f"{id_col} {kind}, ids array<int>")


def pairs(docs: DataFrame, train_fraction: float = 0.9, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """WIN8 + ML3: (ch, next) pairs with ``split`` = train when the target
    position is before ``train_fraction * n`` of its document, else val.
    Pairs are zipped inside each row (the text shifted by one), so no window
    or shuffle is needed."""
    a = F.filter(F.split(F.col(text), ""), lambda x: F.length(x) > 0)
    d = docs.select(F.col(id_col).alias("id"), a.alias("a"))
    m = F.greatest(F.size("a") - 1, F.lit(0))
    z = F.zip_with(F.slice("a", 1, m), F.slice("a", 2, m), lambda x, y: F.struct(x.alias("ch"), y.alias("next")))
    d = d.select("id", F.size("a").alias("n"), F.posexplode(z).alias("pos", "z")).select("id", "n", "pos", "z.ch", "z.next")
    return d.withColumn("split", F.when(F.col("pos") + 1 < F.col("n") * F.lit(train_fraction), F.lit("train")).otherwise(F.lit("val")))


def pair_counts(pair_rows: DataFrame) -> DataFrame:
    """(split, ch, next) -> count from pair rows; partial aggregation shrinks
    them to at most 2 x V^2 rows before the shuffle."""
    return pair_rows.groupBy("split", "ch", "next").agg(F.count(F.lit(1)).alias("cnt"))


def corpus_pair_counts(docs: DataFrame, train_fraction: float = 0.9, text: str = "text") -> DataFrame:
    """WIN8 / ML3: the counts of ``pair_counts(pairs(docs))`` without a row per
    character: each Arrow batch is one array of code points, its pairs are
    counted by value, and a batch emits at most one row per distinct pair and
    split, which a final ``groupBy`` sums. (The row form makes a row for every
    character of the corpus, ten times slower on the test tables.) What a task
    holds beside a batch is bounded by ``PAIR_CHARS`` and the longest text."""
    import numpy as np
    import pyarrow as pa

    def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(t) for t in texts])
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        size = np.repeat(n, n)
        pos = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
        left = np.flatnonzero(pos < size - 1)
        train = pos[left] + 1 < size[left] * train_fraction
        return np.unique(code[left] << np.uint64(22) | code[left + 1] << np.uint64(1) | train.astype(np.uint64), return_counts=True)

    def groups(column) -> Iterator[list[str]]:
        """Texts of a batch, about ``PAIR_CHARS`` characters at a time."""
        held, n = [], 0
        for value in column:
            t = value.as_py()
            if not t:
                continue
            held.append(t)
            n += len(t)
            if n >= PAIR_CHARS:
                yield held
                held, n = [], 0
        if held:
            yield held

    def fn(batches):
        for b in batches:
            key, cnt = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
            for texts in groups(b.column(0)):
                k, c = counts(texts)
                key, at = np.unique(np.concatenate([key, k]), return_inverse=True)
                both = np.zeros(len(key), dtype=np.int64)
                np.add.at(both, at, np.concatenate([cnt, c]))
                cnt = both
            char = lambda c: pa.array([chr(x) for x in c.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.where(key & np.uint64(1), "train", "val").tolist(), pa.string()), char(key >> np.uint64(22)),
                                              char(key >> np.uint64(1) & np.uint64((1 << 21) - 1)), pa.array(cnt)], ["split", "ch", "next", "cnt"])

    from .common import ensure_parallel

    local = ensure_parallel(docs.select(text)).mapInArrow(fn, "split string, ch string, next string, cnt long")
    return local.groupBy("split", "ch", "next").agg(F.sum("cnt").alias("cnt"))


def bigram_model(counts: DataFrame, vocab_size) -> DataFrame:
    """ML15: add-one smoothed next-character probabilities from the train
    counts: ``(ch, next, cnt, ch_cnt, p)``; an unseen pair of a known context
    has ``1 / (count(ch) + V)``."""
    tr = counts.filter(F.col("split") == "train").select("ch", "next", "cnt")
    cc = tr.groupBy("ch").agg(F.sum("cnt").alias("ch_cnt"))
    return tr.join(cc, "ch").withColumn("p", (F.col("cnt") + 1) / (F.col("ch_cnt") + vocab_size))


def cross_entropy(counts: DataFrame, vocab_size, decimals: int = 6) -> DataFrame:
    """ML15: mean negative log-likelihood and perplexity per split under the
    smoothed model trained on the train split (count-weighted, so every pair
    occurrence counts once)."""
    tr = counts.filter(F.col("split") == "train").select("ch", "next", F.col("cnt").alias("tcnt"))
    cc = tr.groupBy("ch").agg(F.sum("tcnt").alias("ch_cnt"))
    scored = counts.join(tr, ["ch", "next"], "left").join(cc, "ch", "left").fillna(0, ["tcnt", "ch_cnt"])
    nll = -F.log((F.col("tcnt") + 1) / (F.col("ch_cnt") + vocab_size))
    return scored.groupBy("split").agg(F.sum("cnt").alias("pairs"),
                                       F.round(F.sum(F.col("cnt") * nll) / F.sum("cnt"), decimals).alias("loss"),
                                       F.round(F.exp(F.sum(F.col("cnt") * nll) / F.sum("cnt")), decimals).alias("perplexity"))


def reshape(model: DataFrame, vocab_size, temperatures: Sequence[float], top_ks: Sequence[int | None],
            decimals: int = 6) -> DataFrame:
    """ML16 / FUN15 / S29: for every context character, temperature then top-k
    on ``ln p`` (ties at the k-th value kept via ``rank``), softmax over the
    kept values; reports entropy (nats) and the original probability mass
    kept. Only observed next characters are candidates."""
    grid = F.array(*[F.struct(F.lit(float(t)).alias("temperature"), F.lit(k).cast("int").alias("top_k"))
                     for t in temperatures for k in top_ks])
    m = model.select("ch", "next", "p").withColumn("g", F.explode(grid)).select("ch", "next", "p", "g.temperature", "g.top_k")
    m = m.withColumn("logit", F.log("p") / F.col("temperature"))
    w = Window.partitionBy("ch", "temperature", "top_k").orderBy(F.col("logit").desc())
    m = m.withColumn("_r", F.rank().over(w)).filter(F.col("top_k").isNull() | (F.col("_r") <= F.col("top_k")))
    wg = Window.partitionBy("ch", "temperature", "top_k")
    m = m.withColumn("_mx", F.max("logit").over(wg))
    m = m.withColumn("_e", F.exp(F.col("logit") - F.col("_mx")))
    m = m.withColumn("q", F.col("_e") / F.sum("_e").over(wg))
    return m.groupBy("ch", "temperature", "top_k").agg(
        F.count(F.lit(1)).alias("kept"),
        (F.round(-F.sum(F.col("q") * F.log("q")), decimals) + F.lit(0.0)).alias("entropy"),  # no negative zero
        F.round(F.sum("p"), decimals).alias("kept_mass"))


def training_blocks(ids: DataFrame, block: int = 128, id_col: str = "doc_id", stride: int | None = None) -> DataFrame:
    """TXT14: fixed-length windows with one-shifted targets over each encoded
    document, starting every ``stride`` positions (deterministic instead of
    random starts)."""
    stride = stride or block
    d = ids.filter(F.size("ids") > block)
    starts = F.sequence(F.lit(1), F.size("ids") - block, F.lit(stride))
    d = d.select(id_col, "ids", F.explode(starts).alias("start"))
    return d.select(id_col, "start", F.slice("ids", F.col("start"), block).alias("x"),
                    F.slice("ids", F.col("start") + 1, block).alias("y"))


def decode(ids: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """FUN21: token ids back to text, where the row lies; ids missing from the
    vocabulary are dropped (the serving rule). The ids of some texts are looked
    up at once, as in :func:`encode`."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    known_bc = ids.sparkSession.sparkContext.broadcast(_in_id_order(vocab))

    def fn(batches):
        known = pa.array(known_bc.value, pa.string())
        for b in batches:
            size = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            for at, n in _row_groups(size.tolist()):
                part = b.slice(at, n)
                found = pc.fill_null(part.column(1).flatten(), -1).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(n), size[at:at + n])
                ok = (found >= 0) & (found < len(known))
                lists = _lists(known.take(pa.array(found[ok])), row[ok], part.column(1).is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(0), pc.binary_join(lists, "")], [id_col, "text"])

    kind = ids.schema[id_col].dataType.simpleString()
    return ids.select(id_col, "ids").mapInArrow(fn, f"{id_col} {kind}, text string")
