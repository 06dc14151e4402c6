"""Exact de-duplication by deterministic block naming, in DataFrame functions only.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted into integer names; then
adjacent names are named as pairs, level by level, until each document is left with one name. Two documents of
equally many blocks have one name if and only if their texts are equal [Karp, Miller and Rosenberg, 1972].

Only the distinct blocks are shuffled with their text (copies collapse in the map tasks). Rows fetch their names
by a handle, a prefix of the block's SHA-256, after the handles were proven to differ between all distinct blocks;
if two blocks share a handle, a longer one is taken. All names come from written tables, so that a lost executor
cannot change them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import free_name, lower_ascii, stored

BLOCK_BYTES = 4096
HANDLE_BYTES = 8


def _handle(block: Column, width: int) -> Column:
    return F.substring(F.sha2(block, 256), 1, 2 * width)


def _named(distinct: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows sorted within their partitions and numbered: unequal rows get unequal names."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def _block_names(blocks: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Names of the distinct blocks by handle, and the width at which no two blocks share a handle."""
    named = _named(blocks.select("block").distinct(), ["block"])
    while True:
        names = stored(named.select(_handle(F.col("block"), width).alias("handle"), "name"), "block-names")
        if names.groupBy("handle").count().filter("count > 1").isEmpty():
            return names, width
        if width >= 32:
            raise ValueError("two different blocks have one SHA-256")
        width *= 2


def identities(rows: DataFrame, block_bytes: int = BLOCK_BYTES, handle_bytes: int = HANDLE_BYTES) -> DataFrame:
    """(row_id, n_blocks, name) of rows (row_id, body binary); the last two are the row's collision-free identity."""
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / block_bytes)).cast("int")
    cut = rows.select("row_id", "body", n_blocks.alias("n_blocks"), F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("pos"))
    blocks = cut.select(
        "row_id", "n_blocks", "pos", F.substring("body", F.col("pos") * block_bytes + 1, F.lit(block_bytes)).alias("block")
    )
    names, width = _block_names(blocks, handle_bytes)
    level = stored(
        blocks.select("row_id", "n_blocks", "pos", F.col("n_blocks").alias("left_over"), _handle(F.col("block"), width).alias("handle"))
        .join(names, "handle")
        .drop("handle"),
        "names-0",
    )
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    done, depth = [], 0
    while True:
        done.append(level.filter("left_over = 1").select("row_id", "n_blocks", "name"))
        if longest == 1:
            break
        longest, depth = (longest + 1) // 2, depth + 1
        odd = F.col("pos") % 2 == 1
        pairs = (
            level.filter("left_over > 1")
            .groupBy("row_id", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.max("n_blocks").alias("n_blocks"),
                F.shiftright(F.max("left_over") + 1, 1).alias("left_over"),
                F.max(F.when(~odd, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("second"),
            )
        )
        pairs = stored(pairs, f"pairs-{depth}")
        names = stored(_named(pairs.select("first", "second").distinct(), ["first", "second"]), f"pair-names-{depth}")
        level = stored(pairs.join(names, ["first", "second"]).drop("first", "second"), f"names-{depth}")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    handle_bytes: int = HANDLE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, raw_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text, and all empty texts are
    equal. The row with the largest id stays (null ids are smallest); of several rows with that id, one. Other
    columns of ``docs`` are ignored. An empty table gives no rows. ``raw_sha256`` is of the text as it came, null
    for null.
    """
    body = lower_ascii(F.col(text_col)).cast("binary")
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id_col).alias("doc_id"),
            F.sha2(F.col(text_col), 256).alias("raw_sha256"),
            body.alias("body"),
        ),
        "dedup-rows",
    )
    ids = stored(identities(rows.select("row_id", "body"), block_bytes, handle_bytes), "identities")
    flat = ids.join(rows.select("row_id", "doc_id", "raw_sha256", F.sha2("body", 256).alias("text_sha256")), "row_id")
    groups = flat.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("best"), F.count("*").alias("group_size")
    )
    groups = stored(groups, "dedup-groups")  # a join of its own, which Spark can split at a large group
    return flat.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
        "raw_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows with one id and one text count once."""
    key = free_name(docs.columns, "dedup_key")
    kept = exact_duplicates(docs, id_col, text_col).filter("kept")
    kept = kept.select(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("raw_sha256", F.lit(""))).alias(key))
    raw = F.coalesce(F.sha2(F.col(text_col), 256), F.lit(""))
    keyed = docs.withColumn(key, F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), raw))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
