"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold the same conversation several times, cut off after more
and more turns. Every turn gets the rolling hash of the turns up to it; a
conversation whose last hash is found at an inner turn of another one is a
prefix of it and is dropped by an anti-join, and of equal conversations the one
with the smallest id stays. What remains is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import stored

# Turn markers of the chat template.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"

BLOCK_TURNS = 512


def _plain(c: Column) -> Column:
    """Text in which nothing can be taken for a turn marker."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def positioned(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Adds ``_block`` (range of turn numbers), ``_pos`` (1-based place in the
    conversation) and ``_n`` (its number of turns).

    Places are row numbers within blocks of turn numbers plus the sizes of the
    earlier blocks, so that a very long conversation is spread over tasks.
    """
    blocked = turns.withColumn("_block", F.coalesce(F.floor(F.col("_turn") / block_turns), F.lit(1 << 60)))
    order = [F.col("_turn").asc_nulls_last(), "_h1", "_h2"]
    inside = blocked.withColumn("_at", F.row_number().over(Window.partitionBy("_conv", "_block").orderBy(*order)))
    sizes = blocked.groupBy("_conv", "_block").agg(F.count(F.lit(1)).alias("_size"))
    conv = Window.partitionBy("_conv")
    starts = sizes.select(
        F.col("_conv").alias("_c"), F.col("_block").alias("_b"), F.sum("_size").over(conv).alias("_n"),
        (F.sum("_size").over(conv.orderBy("_block")) - F.col("_size")).alias("_start"))
    return (inside.join(starts, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")))
            .withColumn("_pos", F.col("_start") + F.col("_at")).drop("_c", "_b", "_start", "_at"))


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """Adds ``_p1`` and ``_p2``: 128 bits that identify the turns up to and with
    this one. Each turn's role and text are hashed together with its place, and
    the hashes of a prefix are folded by exclusive or, first within blocks, then
    over the earlier blocks."""
    terms = placed.select("_conv", "_block", "_pos", "_n", F.xxhash64(F.lit(1), "_pos", "_h1").alias("_t1"),
                          F.xxhash64(F.lit(2), "_pos", "_h2").alias("_t2"))
    run = Window.partitionBy("_conv", "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = terms.select("_conv", "_block", "_pos", "_n", F.bit_xor("_t1").over(run).alias("_x1"),
                          F.bit_xor("_t2").over(run).alias("_x2"))
    whole = terms.groupBy("_conv", "_block").agg(F.bit_xor("_t1").alias("_w1"), F.bit_xor("_t2").alias("_w2"))
    before = Window.partitionBy("_conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        F.col("_conv").alias("_c"), F.col("_block").alias("_b"),
        F.coalesce(F.bit_xor("_w1").over(before), F.lit(0)).alias("_b1"),
        F.coalesce(F.bit_xor("_w2").over(before), F.lit(0)).alias("_b2"))
    joined = inside.join(carried, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")))
    return joined.select("_conv", "_pos", "_n", F.col("_x1").bitwiseXOR(F.col("_b1")).alias("_p1"),
                         F.col("_x2").bitwiseXOR(F.col("_b2")).alias("_p2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """One row (``_conv``, ``_n``, ``_copies``) per conversation that prefixes
    no longer one; of equal ones the smallest id, with their number."""
    hashed = stored(prefix_hashes(positioned(turns.drop("_role", "_text"))), "turn-prefixes")
    key = ["_n", "_p1", "_p2"]
    ends = hashed.where(F.col("_pos") == F.col("_n")).groupBy(*key).agg(
        F.min("_conv").alias("_conv"), F.count(F.lit(1)).alias("_copies"))
    inner = hashed.where(F.col("_pos") < F.col("_n")).select(F.col("_pos").alias("_n"), "_p1", "_p2").distinct()
    return ends.join(inner, key, "left_anti").select("_conv", "_n", "_copies")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part_turns: int = BLOCK_TURNS) -> DataFrame:
    """Collapse snapshots, then render what remains.

    Returns one row per remaining conversation and part of ``part_turns`` turns
    (nearly always one part): the conversation column, ``part`` (from 0),
    ``n_turns`` (of the whole conversation), ``copies`` (equal conversations it
    stands for, itself included) and ``rendered``.

    Turns are ordered by turn number, null last, ties by a hash of role and
    text; two conversations are compared by their roles and texts in this
    order, not by turn numbers. A null role or text differs from an empty one
    and is rendered as empty; turn markers in a text are broken up. Rows with a
    null conversation id are one conversation (it gives way to an equal one
    with an id). Repeated rows are repeated turns. Other columns are not read;
    an empty table gives an empty one.
    """
    role, text = F.col("_role"), F.col("_text")
    parts = [role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit(""))]
    src = turns.select(turns[conv_col].alias("_conv"), turns[turn_col].alias("_turn"), turns[role_col].alias("_role"),
                       turns[text_col].alias("_text"))
    src = src.withColumns({"_h1": F.xxhash64(F.lit(3), *parts), "_h2": F.xxhash64(F.lit(5), *parts)})
    kept = stored(maximal_conversations(src).withColumnRenamed("_conv", "_c").drop("_n"), "maximal-conversations")
    kept_turns = src.join(kept, F.col("_conv").eqNullSafe(F.col("_c"))).drop("_c")
    placed = positioned(kept_turns).withColumn("_part", F.floor((F.col("_pos") - 1) / part_turns).cast("int"))
    line = F.concat(F.lit(TURN_START), _plain(role), F.lit("\n"), _plain(text), F.lit(TURN_END + "\n"))
    grouped = placed.groupBy("_conv", "_part", "_n", "_copies").agg(
        F.sort_array(F.collect_list(F.struct("_pos", line.alias("line")))).alias("lines"))
    return grouped.select(F.col("_conv").alias(conv_col), F.col("_part").alias("part"), F.col("_n").alias("n_turns"),
                          F.col("_copies").alias("copies"), F.array_join(F.col("lines.line"), "").alias("rendered"))
