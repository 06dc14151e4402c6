"""Chat formatting of logged conversations after collapsing cumulative snapshots, in DataFrame functions only.

A service that logs a conversation after each turn leaves snapshots that are prefixes of longer ones. Every turn is
hashed with its number; the rolling hash of a prefix is the running sum of its turns' hashes (two 64-bit ones, summed
as decimals, so that a prefix is told by its length and 128 bits). A conversation is maximal if its whole hash is not
the hash of a proper prefix of another: an anti-join over distinct hashes. Of equal conversations the smallest
id stays. Running sums are taken within blocks of ``BLOCK`` turns and then over the blocks, so that a very long
conversation is many small groups; it is rendered in as many parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableload.llm.common import stored

BLOCK = 512
# The marks of the chat format.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
_SUM = "decimal(38,0)"


def _turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.filter("conv_id is not null and turn is not null")
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return rows.withColumn("content", content).withColumn("block", F.floor(F.col("turn") / BLOCK))


def _hash(seed: int) -> Column:
    return F.xxhash64("turn", "content", F.lit(seed)).cast(_SUM)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, content, n, h1, h2): length and rolling hash of the conversation up to each turn."""
    distinct = turns.select("conv_id", "block", "turn", "content").distinct()
    order = ["turn", "content"]
    inside = Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = distinct.select(
        "*", F.count("*").over(inside).alias("n"), F.sum(_hash(1)).over(inside).alias("h1"), F.sum(_hash(2)).over(inside).alias("h2")
    )
    blocks = distinct.groupBy("conv_id", "block").agg(F.count("*").alias("bn"), F.sum(_hash(1)).alias("b1"), F.sum(_hash(2)).alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(_SUM)
    blocks = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("bn").over(earlier), F.lit(0)).alias("bn"),
        F.coalesce(F.sum("b1").over(earlier).cast(_SUM), zero).alias("b1"),
        F.coalesce(F.sum("b2").over(earlier).cast(_SUM), zero).alias("b2"),
    )
    joined = rows.join(blocks, ["conv_id", "block"])
    return joined.select(
        "conv_id",
        "turn",
        "content",
        (F.col("n") + F.col("bn")).alias("n"),
        (F.col("h1").cast(_SUM) + F.col("b1")).cast(_SUM).alias("h1"),
        (F.col("h2").cast(_SUM) + F.col("b2")).cast(_SUM).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no snapshot of another."""
    rolling = stored(prefixes(turns), "prefixes")
    lengths = rolling.groupBy("conv_id").agg(F.max("n").alias("n_turns"))
    rolling = rolling.join(lengths, "conv_id")
    whole = rolling.filter("n = n_turns").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = rolling.filter("n < n_turns").select("n", "h1", "h2").distinct()
    return whole.join(proper, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def rendered(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per maximal conversation and part: conv_id, part, n_turns, n_copies, chat.

    A conversation is its set of turns (number, role, text) in order of number, role-and-text hash where numbers are
    equal; rows repeated within it count once. Null roles and texts count as empty; rows without an id or turn number
    belong to no conversation. A part holds the turns of ``BLOCK`` consecutive numbers; ordinary conversations are one
    part. ``n_copies`` counts the conversations equal to this one, itself included. Extra columns are ignored.
    """
    turns = _turns(conversations, id_col, turn_col, role_col, text_col)
    kept = stored(maximal(turns), "maximal")
    shown = turns.join(kept, "conv_id").dropDuplicates(["conv_id", "turn", "content"])
    line = F.concat(F.lit(TURN_START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(TURN_END + "\n"))
    parts = shown.groupBy("conv_id", "block", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("turn", "content", line.alias("line")))).alias("lines")
    )
    return parts.select(
        "conv_id", F.col("block").alias("part"), "n_turns", "n_copies", F.array_join("lines.line", "").alias("chat")
    )
