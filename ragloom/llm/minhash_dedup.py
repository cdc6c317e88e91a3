"""Near-duplicates by BagMinHash signatures, bands and exact multiset overlap.

A text is the multiset of its five-word shingles. Every shingle carries a
Poisson process over its weight, laid out hierarchically: the weight axis is cut
into the units [0, 1), [1, 2), [2, 4), [4, 8) and so on, each piece has a process
of its own with the piece's length as rate, and a point of a piece is placed on
one of the piece's units by halving it again and again (the bits of a hash). A
shingle of weight w owns the points below w. Each point falls on one register; a
register keeps its earliest point. Two registers agree with a probability equal
to the weighted Jaccard similarity. Points come in order of time, so a shingle
is done once its next point is later than all registers of the text.

Bands of registers give candidate buckets. Within a bucket texts are compared
with one of them first; what that does not settle is compared block by block
(see ``links``). Every link rests on the exact overlap of the whole texts.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .session import stored
from .shingles import counted, mix, multiset_similarity, shingle_hashes, text_blocks, word_hashes

_U = np.uint64
BLOCK_ROWS = 512


@dataclass(frozen=True)
class Bands:
    """``bands`` bands of ``rows`` registers. With 40 bands of 6, a pair of
    similarity 0.8 shares no bucket with a probability of 5e-6."""

    bands: int = 40
    rows: int = 6

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def _pieces(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of the weight axis below each value's weight: index of the value,
    seed, start and length of the piece."""
    at, seed, low, length = [np.arange(len(values))], [values], [np.zeros(len(values), np.int64)], [np.ones(len(values), np.int64)]
    level, start = 1, 1
    big = np.flatnonzero(counts > start)
    while len(big):
        at.append(big)
        seed.append(mix(values[big] + _U(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
        low.append(np.full(len(big), start, np.int64))
        length.append(np.full(len(big), start, np.int64))
        level, start = level + 1, start * 2
        big = big[counts[big] > start]
    return np.concatenate(at), np.concatenate(seed), np.concatenate(low), np.concatenate(length)


def _fill(registers: np.ndarray, owner: np.ndarray, values: np.ndarray, counts: np.ndarray, ahead: int) -> None:
    """Run all processes until no point can change a register. ``registers``:
    texts x registers, infinite; ``owner``: each value's text; ``ahead``: points
    drawn at a time."""
    m = registers.shape[1]
    flat = registers.reshape(-1)
    at, seed, low, length = _pieces(values, counts)
    text, weight = owner[at], counts[at]
    time = np.zeros(len(at))
    drawn = 0
    while len(at):
        h = mix(seed[:, None] + (np.arange(drawn, drawn + ahead, dtype=np.uint64) * _U(0xD1342543DE82EF95))[None, :])
        gap = -np.log(((h >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / length[:, None]
        gap[:, 0] += time
        when = np.cumsum(gap, axis=1)
        g = mix(h ^ _U(0xA0761D6478BD642F))
        cell = (((g >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64) + (text * m)[:, None]
        use = when < registers.max(axis=1)[text][:, None]
        partly = length > 1
        if partly.any():
            unit = low[partly][:, None] + (g[partly] & _U(0xFFFFFFFF)).astype(np.int64) % length[partly][:, None]
            use[partly] &= unit < weight[partly][:, None]
        np.minimum.at(flat, cell[use], when[use])
        drawn += ahead
        time = when[:, -1]
        go = time < registers.max(axis=1)[text]
        if not go.all():
            seed, low, length, text, weight, time = seed[go], low[go], length[go], text[go], weight[go], time[go]
            at = at[go]


def signatures(values: np.ndarray, counts: np.ndarray, offsets: np.ndarray, registers: int) -> np.ndarray:
    """BagMinHash registers (arrival times) of each text's multiset; rows of
    texts without shingles stay infinite. Texts are run together by size, the
    smaller ones with more points at a time."""
    n = np.diff(offsets)
    out = np.full((len(n), registers), np.inf)
    for least, most in ((1, 8), (8, 64), (64, 512), (512, 1 << 62)):
        docs = np.flatnonzero((n >= least) & (n < most))
        if not len(docs):
            continue
        owner = np.repeat(np.arange(len(docs)), n[docs])
        first = np.cumsum(n[docs]) - n[docs]
        index = np.arange(len(owner)) - np.repeat(first, n[docs]) + np.repeat(offsets[docs], n[docs])
        part = np.full((len(docs), registers), np.inf)
        _fill(part, owner, values[index], counts[index], max(1, 2 * registers // least if least < 512 else 1))
        out[docs] = part
    return out


def band_hashes(registers: np.ndarray, bands: Bands) -> np.ndarray:
    """One 64-bit hash per text and band."""
    bits = registers.view(np.uint64).reshape(len(registers), bands.bands, bands.rows)
    acc = np.zeros(bits.shape[:2], dtype=np.uint64)
    for i in range(bands.rows):
        acc = mix(acc + bits[:, :, i] + _U(i))
    return mix(acc ^ np.arange(1, bands.bands + 1, dtype=np.uint64)[None, :])


def multisets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, counts and offsets of each text."""
    words, offsets = word_hashes(texts)
    return counted(*shingle_hashes(words, offsets))


def _signed(docs: DataFrame, bands: Bands) -> DataFrame:
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in range(0, batch.num_rows, 2048):
                part = batch.slice(whole, 2048)
                texts = part.column(1).to_pylist()
                for i, j in text_blocks(texts):
                    block = texts[i:j]
                    values, counts, offsets = multisets(block)
                    hashes = band_hashes(signatures(values, counts, offsets, bands.registers), bands).view(np.int64)
                    some = np.diff(offsets) > 0
                    lists = pa.array([row if ok else None for row, ok in zip(hashes, some, strict=True)], pa.list_(pa.int64()))
                    keys = pa.array([None if t is None else hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in block], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(i, j - i), keys, lists], ["_id", "_key", "_bands"])

    return docs.mapInArrow(run, f"_id {kind}, _key binary, _bands array<bigint>")


def _similarities(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Exact weighted Jaccard of each pair (a, b) of ids; the largest one where
    an id has several texts."""
    rows = (pairs.join(bodies.select(F.col("_id").alias("b"), F.col("_text").alias("_tb")), "b")
            .join(bodies.select(F.col("_id").alias("a"), F.col("_text").alias("_ta")), "a").select("a", "b", "_ta", "_tb"))
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict = OrderedDict()

        def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
            if text in recent:
                recent.move_to_end(text)
                return recent[text]
            values, counts, _ = multisets([text])
            recent[text] = values, counts
            if len(recent) > 16:
                recent.popitem(last=False)
            return values, counts

        for batch in batches:
            ta, tb = batch.column(2), batch.column(3)
            sims = [multiset_similarity(bag(ta[i].as_py() or ""), multisets([tb[i].as_py()])[:2]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], ["a", "b", "sim"])

    found = rows.mapInArrow(run, f"a {kind}, b {kind}, sim double")
    return found.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col("a") != F.col("b")).distinct()


def _compare(table: pa.Table, i: int, j: int, least: float, bands: Bands) -> list[tuple[int, int]]:
    """Links between the rows of block ``i`` and of block ``j`` that join two
    components of one group, a spanning set of them. Pairs must share a band;
    pairs whose registers agree so rarely that the threshold is five standard
    deviations away are not verified."""
    texts = table.column("_text").to_pylist()
    values, counts, offsets = multisets(texts)
    registers = signatures(values, counts, offsets, bands.registers)
    keys = band_hashes(registers, bands)
    own = table.column("_own").to_numpy()
    group = table.column("_group").to_numpy()
    node = table.column("id").to_pylist()
    comp = table.column("comp").to_pylist()
    bags = [(values[x:y], counts[x:y]) for x, y in zip(offsets, offsets[1:], strict=False)]
    parent: dict = {c: c for c in comp}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    low = least - 5 * (least * (1 - least) / bands.registers) ** 0.5
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    out = []
    for x in left:
        others = right[(group[right] == group[x]) & ((right > x) | (i != j))]
        others = others[(keys[others] == keys[x]).any(axis=1)]
        agree = (registers[others] == registers[x]).mean(axis=1)
        for k in np.argsort(-agree, kind="stable"):
            if agree[k] < low:
                break
            y = others[k]
            rx, ry = root(comp[x]), root(comp[y])
            if rx != ry and multiset_similarity(bags[x], bags[y]) >= least:
                parent[max(rx, ry)] = min(rx, ry)
                out.append((node[x], node[y]))
    return out


def links(buckets: DataFrame, bodies: DataFrame, least: float, bands: Bands) -> DataFrame:
    """Exact links (a, b) that connect what the buckets hold together.

    ``buckets``: (bucket, id), at least two ids a bucket; ``bodies``: (_id,
    _text). First every id is compared with the smallest id it shares a bucket
    with; that settles buckets of copies with one comparison an id. Buckets
    whose ids are still several components are gathered into groups of ids that
    they connect; groups are cut into blocks, and every pair of blocks is
    compared in a task of its own, which returns links between components only.
    So two components that this returns hold no linked pair with a bucket in
    common, and a group of n ids makes at most about n rows for each of its
    n / ``BLOCK_ROWS`` blocks.
    """
    lead = buckets.groupBy("bucket").agg(F.min("id").alias("lead"))
    nearest = buckets.join(lead, "bucket").groupBy("id").agg(F.min("lead").alias("lead"))
    tested = stored(_similarities(_ordered(nearest, "lead", "id"), bodies), "tested")
    first = tested.where(F.col("sim") >= least).select("a", "b")
    comps = stored(components(first, "a", "b"), "first-components")
    labelled = (buckets.join(comps, F.col("id") == F.col("node"), "left")
                .select("bucket", "id", F.coalesce("component", "id").alias("comp")))
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.min("id").alias("_lead")).where("_lo <> _hi")
    open_rows = stored(labelled.join(mixed.select("bucket", "_lead"), "bucket"), "open-buckets")
    groups = stored(components(open_rows, "_lead", "id").select("node", F.col("component").alias("_group")), "groups")
    members = (open_rows.select("id", "comp").distinct().join(groups, F.col("id") == F.col("node")).drop("node"))
    sizes = members.groupBy("_group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("_blocks"))
    packs = int(members.count() // BLOCK_ROWS) + 1
    spread = (members.join(sizes, "_group")
              .withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")})
              # small groups share a task, large ones have one for each pair of blocks
              .withColumn("_pack", F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64("_group"), F.lit(packs))).otherwise(-1 - F.pmod(F.xxhash64("_group"), F.lit(1 << 40)))))
    full = spread.join(bodies.select(F.col("_id").alias("id"), "_text"), "id").select("_pack", "_i", "_j", "_own", "_group", "id", "comp", "_text")
    kind = buckets.schema["id"].dataType.simpleString()

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = _compare(table, key[1].as_py(), key[2].as_py(), least, bands)
        ids = table.column("id").type
        return pa.table({"a": pa.array([a for a, _ in found], ids), "b": pa.array([b for _, b in found], ids)})

    more = full.groupBy("_pack", "_i", "_j").applyInArrow(run, f"a {kind}, b {kind}")
    return first.unionAll(stored(more, "block-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8,
                    bands: Bands = Bands()) -> DataFrame:
    """Classes of equal and near-equal texts over all rows.

    Returns one row per distinct id: the id column, ``class_id`` (the smallest
    id reachable by links) and ``kept`` (it is that id). Equal texts, empty ones
    too, are linked; different texts are linked if the weighted Jaccard
    similarity of their shingle multisets is ``least`` or more and they share a
    band. Texts of one to four words have one shingle; texts without words link
    only with equal ones. A null text is linked with nothing. Rows that share an
    id are one document, linked by any of its texts. Rows with a null id are
    compared with nothing and come back one by one, without a class and kept.
    Other columns are not read; an empty table gives an empty one.
    """
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    signed = stored(_signed(src.where(F.col("_id").isNotNull()), bands), "signatures")
    # one node per distinct text, named by its smallest id
    nodes = stored(signed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_id").alias("_node"), F.first("_bands").alias("_bands")), "nodes")
    member = stored(signed.select("_id", "_key").distinct().join(nodes.select("_key", "_node"), "_key", "left")
                    .select("_id", F.coalesce("_node", "_id").alias("_node")).distinct(), "members")
    exploded = nodes.select(F.col("_node").alias("id"), F.explode("_bands").alias("bucket")).distinct()
    shared = exploded.groupBy("bucket").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo <> _hi").select("bucket")
    buckets = stored(exploded.join(shared, "bucket").select("bucket", "id"), "buckets")
    wanted = buckets.select(F.col("id").alias("_id")).distinct()
    texts = src.where(F.col("_text").isNotNull()).join(wanted, "_id", "left_semi")
    bodies = stored(texts, "bodies")
    found = links(buckets, bodies, least, bands).select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = member.groupBy("_id").agg(F.min("_node").alias("_lo"), F.max("_node").alias("_hi"))
    several = member.join(low.where("_lo <> _hi"), "_id").select(F.col("_lo").alias("u"), F.col("_node").alias("v"))
    comps = components(found.unionAll(several))
    out = (low.join(comps, F.col("_lo") == F.col("node"), "left")
           .select(F.col("_id").alias(id_col), F.coalesce("component", "_lo").alias("class_id")))
    nulls = src.where(F.col("_id").isNull()).select(F.col("_id").alias(id_col), F.col("_id").alias("class_id"))
    return out.unionAll(nulls).withColumn("kept", F.coalesce(F.col("class_id") == F.col(id_col), F.lit(True)))
