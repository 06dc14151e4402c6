"""Grouped prefix join: connected components of documents whose shingle sets have a Jaccard similarity of at least a threshold.

Sets are ordered rare shingles first, so that two similar sets must share a shingle of their prefixes (the first
n - ceil(t n) + 1). Rows with equal sets become one class; classes of equal size and prefix become one group
[Bouros, Ge and Mamoulis, 2012]. Groups meet on shared prefix shingles and are filtered by size and position; only
then are they expanded to their classes, filtered by a signature and verified on whole texts.

Joining goes in two rounds, so that a family of m near copies does not cost m*m comparisons. The first compares each
class with its group's first and each group with the pivots of the shingles it shares. The second takes every other
pair of groups that shares a prefix shingle and is not already one component, and verifies all their pairs of classes
from different components. Every candidate pair is thus either verified or already connected, which is all that
components need. A pair of the second round is made at the first shingle it shares, not at each, and only if the
shingles that one prefix holds and no other group does leave enough to share.

The order of shingles uses a bounded summary of frequent ones. It only steers how many candidates there are: any
order common to all sets gives the same components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tableload.llm.common import components, free_name, release_memory, stored, text_slices

SHINGLE_WORDS = 5
SIMILARITY = 80  # hundredths
SUMMARY_KEYS = 1 << 17  # frequent shingles known to every task: 2 MB
SUMMARY_LOCAL = 1 << 18  # shingles one task keeps while it counts
KNOWN_WORDS = 100_000  # words whose hashes one task keeps: 15 MB
SLICE_BYTES = 2 << 20  # texts that one task turns into Python objects at a time
BEFORE = 4  # shingles kept with each posting of the second round, to see that a pair has met before

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def _multipliers(size: int) -> list[np.uint64]:
    """One odd number for each place in a shingle."""
    return [np.uint64(xxhash.xxh3_64_intdigest(b"", seed=i) | 1) for i in range(size)]


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None, hashes: dict, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; one of the whole sequence if it has fewer words."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for i, multiplier in enumerate(_multipliers(size)):
        out += h[i : i + n] * multiplier
    out = np.sort(_spread(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def _reduced(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(keys, return_inverse=True)
    counts = np.bincount(where, counts, len(keys)).astype(np.int64)
    if len(keys) > most:
        best = np.sort(np.lexsort((keys, -counts))[:most])
        keys, counts = keys[best], counts[best]
    return keys, counts


def frequent_shingles(docs: DataFrame, text_col: str, size: int, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``keys`` frequent shingles, sorted, with their counts: a bounded summary of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, rows = _WordHashes(), [], 0
        found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merge():
            some, n = np.unique(np.concatenate(waiting), return_counts=True)
            some, n = some[n > 1], n[n > 1]
            return _reduced(np.concatenate([found, some]), np.concatenate([counts, n]), SUMMARY_LOCAL)

        for batch in text_slices(batches, SLICE_BYTES):
            for text in _texts(batch, text_col):
                waiting.append(shingle_set(text, hashes, size))
                rows += len(waiting[-1])
            if rows > 2_000_000:
                found, counts = merge()
                waiting, rows = [], 0
                release_memory()
        if waiting:
            found, counts = merge()
        waiting.clear()
        hashes.clear()
        release_memory()
        often = counts >= 4
        yield pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(counts[often])], ["token", "n"])

    found = stored(docs.select(text_col).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter("n >= 8"), "frequent")
    # the most frequent ones that fit, by six leading bits of their counts: at most a few hundred rows decide
    rough = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 6, 0)), greatest(length(bin(n)) - 6, 0))")
    sizes = found.groupBy(rough.alias("rough")).count().toPandas().sort_values("rough", ascending=False)
    fits = sizes["rough"][sizes["count"].cumsum() <= keys]
    top = found.filter(rough >= int(fits.min()) if len(fits) else F.lit(False)).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


def prefix_of(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: int) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles of a set: those not known as frequent by hash, then by frequency."""
    n = len(tokens)
    p = n - (similarity * n + 99) // 100 + 1
    if not len(frequent):
        return tokens[:p]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    known = frequent[at] == tokens
    rare = tokens[~known]
    if len(rare) >= p:
        return rare[:p]
    often, at = tokens[known], at[known]
    return np.concatenate([rare, often[np.lexsort((often, counts[at]))]])[:p]


def _last_place(prefix: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> int:
    """Where a prefix ends in the order of shingles: a number that never falls along the order; distinct ones may share it."""
    if not len(prefix):
        return 0
    at, token = int(np.searchsorted(frequent, prefix[-1])), int(prefix[-1])
    if at == len(frequent) or int(frequent[at]) != token:
        return token >> 2
    count = int(counts[at])
    return (1 << 62) + (count << 32) + (token >> 32) if count < 1 << 30 else (1 << 63) - 1


def _signature(tokens: np.ndarray) -> bytes:
    """Shingles per cell of the hash space, about two a cell, at most 255; the number of cells is a power of two."""
    bits = min(16, max(4, (len(tokens) // 2).bit_length()))
    return np.minimum(np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in one of two sets only: |a - b| summed over common cells."""
    x, y = (np.frombuffer(s, np.uint8).astype(np.int32) for s in (a, b))
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = y.reshape(len(x), -1)
        if y.max() == 255:  # cut off: the sum of its parts is no count
            return 0
        y = y.sum(axis=1)
        x, y = np.minimum(x, 255), np.minimum(y, 255)
    return int(np.abs(x - y).sum())


def described(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: int, keys: int) -> DataFrame:
    """Per row of ``docs``: row, doc_id, n, set_key, prefix_key, signature, last, prefix. Stored."""
    frequent, counts = frequent_shingles(docs, text_col, size, keys)
    shared = docs.sparkSession.sparkContext.broadcast((frequent, counts))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (known, often) = _WordHashes(), shared.value
        for batch in text_slices(batches, SLICE_BYTES):
            sets = [shingle_set(t, hashes, size) for t in _texts(batch, "text")]
            prefixes = [prefix_of(s, known, often, similarity) for s in sets]
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([xxhash.xxh3_128_digest(p.tobytes(), seed=len(s)) for s, p in zip(sets, prefixes)], pa.binary()),
                    pa.array([_signature(s) for s in sets], pa.binary()),
                    pa.array([_last_place(p, known, often) for p in prefixes], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))),
                ],
                ["row", "doc_id", "n", "set_key", "prefix_key", "signature", "last", "prefix"],
            )
            del sets, prefixes, flat
            release_memory()
        hashes.clear()
        release_memory()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "row long, doc_id long, n long, set_key binary, prefix_key binary, signature binary, last long, prefix array<long>"
    return stored(rows.mapInArrow(describe, schema), "sets")


def _alike_in_size(a: str, b: str, similarity: int):
    return F.expr(f"100 * least({a}, {b}) >= {similarity} * greatest({a}, {b})")


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, similarity: int) -> DataFrame:
    """Of the pairs (a, b) of classes those whose texts are similar; stored. Signatures first, then whole texts."""
    light = classes.select("class", "n", "signature")
    for side in ("a", "b"):
        pairs = pairs.join(
            light.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}")), side
        )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):  # signatures of long texts have up to 64 KB
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = np.fromiter(map(_least_difference, batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist()), np.int64, len(total))
            most = (total - apart) // 2
            yield batch.select(["a", "b"]).filter(pa.array(100 * most >= similarity * (total - most)))
        release_memory()

    pairs = stored(pairs.filter(_alike_in_size("n_a", "n_b", similarity)).mapInArrow(near, "a long, b long"), "near-pairs")

    # texts of the classes that are still in some pair, found by id; the set's key tells rows with one id apart
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    needed = needed.join(classes.select("class", "doc_id", "set_key"), "class")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = source.join(needed, F.col("id").eqNullSafe(F.col("doc_id"))).select("class", "set_key", "text")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in text_slices(batches, SLICE_BYTES):
            right = [
                xxhash.xxh3_128_digest(shingle_set(t, hashes, size).tobytes()) == k
                for t, k in zip(_texts(batch, "text"), batch.column("set_key").to_pylist())
            ]
            yield batch.select(["class", "text"]).filter(pa.array(right, pa.bool_()))
            release_memory()
        hashes.clear()
        release_memory()

    # several rows of one id and one set may differ in case or spaces: any of them has the set
    texts = stored(found.mapInArrow(own, "class long, text string").dropDuplicates(["class"]), "texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = _WordHashes(), {}
        for batch in text_slices(batches, SLICE_BYTES):
            fits = []
            for a, left, right in zip(batch.column("a").to_pylist(), _texts(batch, "text_a"), _texts(batch, "text_b")):
                if a not in kept:
                    if len(kept) > 200:
                        kept.clear()
                    kept[a] = shingle_set(left, hashes, size)
                x, y = kept[a], shingle_set(right, hashes, size)
                both = len(np.intersect1d(x, y, assume_unique=True))
                fits.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))
            release_memory()
        hashes.clear()
        kept.clear()
        release_memory()

    wide = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return stored(wide.mapInArrow(verify, "a long, b long"), "links")


def _order():
    """A random order of groups, one of four for each shingle."""
    return F.xxhash64("group", F.pmod("token", F.lit(4)))


def _open_postings(postings: DataFrame, groups: DataFrame, spans: DataFrame, similarity: int) -> DataFrame:
    """Postings of shingles whose groups are not all in one component, with lo, hi, last, alone and before; stored.

    ``alone`` counts the shingles of a prefix that stand in no other, or in those of its own component only;
    ``before`` holds the open shingles that stand just before this one.
    """
    postings = postings.select("token", "group", "n", "pos")
    mixed = postings.join(spans, "group").groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h"))
    rows = postings.join(mixed.filter("l <> h").select("token"), "token", "left_semi")
    own = Window.partitionBy("group")
    length = F.expr(f"n - ({similarity} * n + 99) div 100 + 1")
    rows = rows.select(
        "*",
        (length - F.count("*").over(own)).alias("alone"),
        F.collect_list("token").over(own.orderBy("pos").rowsBetween(-BEFORE, -1)).alias("before"),
    )
    return stored(rows.join(spans, "group").join(groups.select("group", "last"), "group"), "open-postings")


def _meetings(postings: DataFrame, similarity: int) -> DataFrame:
    """Pairs (g, h) of groups from different components that share a prefix shingle; a pair may come more than once."""
    x, y = postings.alias("x"), postings.alias("y")
    # the first shingle that two similar sets share stands where enough of both is left: at it, if not at the others,
    # the pair passes; where both prefixes hold one that stands before, the pair has met there. What a prefix alone
    # holds is not in a set whose prefix ends later: it would stand in that prefix, too
    reach = F.expr(
        "least(x.n - x.pos, y.n - y.pos, if(x.last < y.last, x.n - x.alone, x.n), if(y.last < x.last, y.n - y.alone, y.n))"
    )
    pairs = x.join(
        y,
        F.expr("x.token = y.token and x.`group` < y.`group` and not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)")
        & _alike_in_size("x.n", "y.n", similarity)
        & (reach * (100 + similarity) >= F.expr("x.n + y.n") * similarity)
        & F.expr("not arrays_overlap(x.before, y.before)"),
    )
    return pairs.select(F.col("x.group").alias("g"), F.col("y.group").alias("h"))


def _open_pairs(postings: DataFrame, spans: DataFrame, placed: DataFrame, similarity: int) -> DataFrame:
    """All pairs (a, b) of classes from different components whose groups can be similar or are one group."""
    pairs = _meetings(postings, similarity).distinct()
    pairs = pairs.unionByName(spans.filter("lo <> hi").select(F.col("group").alias("g"), F.col("group").alias("h")))
    left = placed.select(F.col("class").alias("a"), F.col("group").alias("g"), F.col("component").alias("c"))
    right = placed.select(F.col("class").alias("b"), F.col("group").alias("h"), F.col("component").alias("d"))
    return pairs.join(left, "g").join(right, "h").filter("c <> d and (g <> h or a < b)").select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
    summary_keys: int = SUMMARY_KEYS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id, component_id.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A set holds the distinct ``size``-word
    shingles of the whole text, or the whole sequence if it has fewer words; null, empty and blank texts have no
    set and link with nothing. Sets link when 100 * |both| >= similarity * |either|. ``class_id`` is the smallest id
    with the same set, ``component_id`` the smallest that links lead to, both the own id where there is none.
    Rows with one id are told apart by their texts; a null id is smaller than no other. Extra columns are ignored.
    """
    sets = described(docs, id_col, text_col, size, similarity, summary_keys)
    full = sets.filter("n > 0")
    classes = stored(
        full.groupBy("set_key").agg(
            F.min(F.struct("row", "doc_id")).alias("first"),
            F.min("doc_id").alias("low"),
            F.first("n").alias("n"),
            F.first("prefix_key").alias("prefix_key"),
            F.first("signature").alias("signature"),
        ).select(F.col("first.row").alias("class"), F.col("first.doc_id").alias("doc_id"), "set_key", "low", "n", "prefix_key", "signature"),
        "classes",
    )
    groups = stored(
        full.groupBy("prefix_key").agg(
            F.min("row").alias("group"), F.first("n").alias("n"), F.first("last").alias("last"), F.first("prefix").alias("prefix")
        ),
        "groups",
    )
    members = stored(classes.select("class", "prefix_key").join(groups.select("group", "prefix_key"), "prefix_key").drop("prefix_key"), "members")

    # prefix shingles that two groups or more share, with two pivots: the group in whose prefix the shingle stands
    # foremost, and the first in one of a few random orders
    postings = groups.select("group", "n", F.posexplode("prefix").alias("pos", "token"))
    place = F.shiftleft(F.least("pos", F.lit(1023)).cast("long"), 53).bitwiseOR(F.col("group"))
    pivots = postings.groupBy("token").agg(
        F.count("*").alias("c"), F.min(place).alias("place"), F.min_by("group", _order()).alias("other")
    )
    pivots = pivots.filter("c > 1").select("token", F.col("place").bitwiseAND(F.lit((1 << 53) - 1)).alias("pivot"), "other")
    postings = stored(postings.join(pivots, "token"), "postings")

    def verified(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried")
        if pairs.isEmpty():
            return pairs, pairs
        return pairs, _linked(pairs, classes, docs, id_col, text_col, size, similarity)

    first = members.select(F.col("group").alias("a"), F.col("class").alias("b"))
    for pivot in ("pivot", "other"):
        first = first.unionByName(postings.select(F.col(pivot).alias("a"), F.col("group").alias("b")))
    tried, links = verified(first.filter("a <> b"))
    joined = stored(components(links), "joined")

    # what is still open: shingles shared by groups that are not all in one component
    placed = members.join(joined.withColumnRenamed("node", "class"), "class", "left")
    placed = stored(placed.select("class", "group", F.coalesce("component", "class").alias("component")), "placed")
    spans = placed.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    postings = _open_postings(postings, groups, spans, similarity)
    rest = _open_pairs(postings, spans, placed, similarity)
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    _, more = verified(rest.join(tried, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = stored(components(known.unionByName(more)), "joined")
    joined = joined.withColumnRenamed("node", "class")
    spread = classes.select("class", "set_key", "low").join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    lowest = spread.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = stored(spread.join(lowest, "component").select("set_key", F.col("low").alias("class_id"), "component_id"), "ids")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "set_key")
    return rows.join(ids, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest id (null last).

    Rows are documents of their own: of repeated rows and of rows without an id, too, one stays. Texts without words are
    linked with nothing and stay. An empty table gives no rows.
    """
    gone = free_name(docs.columns, "gone_key")
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("id")).groupBy("id").count()
    if ids.filter("id is null or count > 1").isEmpty():  # an id tells a row from all others
        near = near_duplicates(docs, id_col, text_col, size, similarity)
        dropped = stored(near.filter("doc_id <> component_id").select(F.col("doc_id").alias(gone)), "dropped")
        return docs.join(dropped, F.col(f"`{id_col}`").cast("long") == F.col(gone), "left_anti")
    key = free_name(docs.columns, "row_key")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = near_duplicates(rows, key, text_col, size, similarity).select(F.col("doc_id").alias("key"), "component_id")
    found = stored(found, "near-rows")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    named = rows.select(F.col(key).alias("key"), F.col(f"`{id_col}`").alias("id"))
    grouped = found.join(several, "component_id").join(named, "key")
    first = grouped.groupBy("component_id").agg(F.min_by("key", F.struct(F.col("id").isNull(), "id", "key")).alias("first"))
    dropped = stored(grouped.join(first, "component_id").filter("key <> first").select(F.col("key").alias(gone)), "dropped")
    return rows.join(dropped, F.col(key) == F.col(gone), "left_anti").drop(key)
