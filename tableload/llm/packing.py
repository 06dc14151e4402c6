"""Packing of tokenized documents into sequences of fixed length: cutting stock by column generation.

A document gives as many full sequences as it can; what is left of it is one piece, or two if it is longer than half
a sequence (pieces over half could not be paired and would leave much padding). The lengths of these pieces, rounded up to a few hundred classes (exact when short, to 1/64 otherwise), are counted by Spark.
On that histogram, whose size does not depend on the data, a linear program chooses how often to use which pattern of
classes: a knapsack by dynamic programming prices new patterns until none improves the plan by more than
``TOLERANCE``. The plan is rounded down and the few pieces left over are put together by subset sums. Pieces are then
ranked within their class, in blocks, and the rank says which copy of which pattern a piece belongs to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tableload.llm.common import release_memory, stored, text_slices
from tableload.llm.segments import encoder

LENGTH = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
TOLERANCE = 0.0005
ROUNDS = 400
SMOOTHING = 0.7
RANK_BLOCK = 50_000  # pieces ranked together


def length_classes(length: int) -> np.ndarray:
    """The lengths that classes stand for: 1 to 64, then in steps of a 64th of the power of two below, at least 2."""
    out, at = list(range(1, min(64, length) + 1)), 64
    while at < length:
        step = max(2, 1 << max(0, at.bit_length() - 7))
        at = min(at + step, length)
        out.append(at)
    return np.array(out)


def _dot(rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """A matrix times a vector without BLAS: its threads are lost where numpy was loaded before the JVM was forked."""
    return np.einsum("ij,j->i", rows, column)


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse of a regular matrix by elimination, row by row, with the largest pivot; without LAPACK, as ``_dot``."""
    n = len(matrix)
    rows = np.hstack([matrix.astype(float), np.eye(n)])
    for at in range(n):
        pivot = at + int(np.abs(rows[at:, at]).argmax())
        if pivot != at:
            rows[[at, pivot]] = rows[[pivot, at]]
        rows[at] /= rows[at, at]
        factors = rows[:, at].copy()
        factors[at] = 0.0
        rows -= factors[:, None] * rows[at]
    return rows[:, n:]


def _knapsack(widths: np.ndarray, values: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of classes within a length (any number of each)."""
    useful = np.flatnonzero(values > 1e-12)
    if not len(useful):
        return 0.0, np.zeros(len(widths), np.int64)
    w, v = widths[useful], values[useful]
    best, last = np.zeros(length + 1), np.full(length + 1, -1)
    order = np.argsort(w)
    w, v, useful = w[order], v[order], useful[order]
    fits = np.searchsorted(w, np.arange(length + 1), side="right")
    for room in range(int(w[0]), length + 1):
        n = fits[room]
        total = best[room - w[:n]] + v[:n]
        at = int(total.argmax())
        if total[at] > best[room - 1]:
            best[room], last[room] = total[at], at
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(widths), np.int64), length
    while room > 0:
        if last[room] < 0:
            room -= 1
            continue
        pattern[useful[last[room]]] += 1
        room -= int(w[last[room]])
    return float(best[length]), pattern


def _tight(widths: np.ndarray, left: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Patterns that use up a few pieces: the longest one left, and others that fill the room best [Gupta and Ho, 1999]."""
    left = left.copy()
    order = [int(c) for c in np.argsort(-widths)]
    while left.any():
        first = next(c for c in order if left[c])
        pattern = np.zeros(len(widths), np.int64)
        pattern[first] = 1
        left[first] -= 1
        room = length - int(widths[first])
        sums, items = [1], []  # bit s of sums[-1]: some of the items so far are s long together
        for c in order:
            width = int(widths[c])
            for _ in range(min(int(left[c]), room // width)):
                if sums[-1] >> room & 1:
                    break
                sums.append((sums[-1] | sums[-1] << width) & ((1 << room + 1) - 1))
                items.append(c)
        at = sums[-1].bit_length() - 1
        for i in range(len(items), 0, -1):
            if not sums[i - 1] >> at & 1:
                pattern[items[i - 1]] += 1
                at -= int(widths[items[i - 1]])
        left -= pattern
        left[first] += 1
        yield pattern


def _greedy(widths: np.ndarray, demand: np.ndarray, length: int) -> list[tuple[np.ndarray, int]]:
    """A first plan: tight patterns, each used as often as the pieces last, so that some class is used up each time."""
    left, out = demand.astype(np.int64).copy(), []
    while left.any() and len(out) < 3 * len(widths):
        pattern = next(_tight(widths, left, length))
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        out.append((pattern, times))
        left -= pattern * times
    return out


def cutting_stock(widths: np.ndarray, demand: np.ndarray, length: int) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each class in one sequence) and how often to use them, so that they meet the demand exactly."""
    m = len(widths)
    if not m:
        return []
    need = demand.astype(float)
    patterns = [np.where(np.arange(m) == i, length // widths[i], 0) for i in range(m)]
    inverse = np.diag(1.0 / np.array([p[i] for i, p in enumerate(patterns)]))
    pool = np.array([p for p, _ in _greedy(widths, demand, length)])
    centre = widths / length  # the prices that gave the best lower bound so far; these are feasible
    bound = float((centre * need).sum())
    for turn in range(ROUNDS):
        if turn % 25 == 24:
            inverse = inverted(np.array(patterns, float).T)  # against rounding errors
        plan, prices = _dot(inverse, need), inverse.sum(axis=0)
        total = plan.sum()
        worths = _dot(pool, prices)
        column = pool[int(worths.argmax())]
        if worths.max() <= 1 + 1e-6:
            if total - bound < max(0.5, TOLERANCE * total):
                break
            smooth = SMOOTHING * centre + (1 - SMOOTHING) * prices  # calmer prices find better patterns [Wentges, 1997]
            for asked in (smooth, prices):
                worth, column = _knapsack(widths, asked, length)
                least = float((np.maximum(asked, 0) * need).sum()) / max(worth, 1e-12)
                if least > bound:
                    centre, bound = np.maximum(asked, 0) / max(worth, 1e-12), least
                if float((column * prices).sum()) > 1 + 1e-9:
                    break
            else:
                break
        change = _dot(inverse, column)
        up = change > 1e-7
        ratio = np.where(up, np.maximum(plan, 0) / np.where(up, change, 1), np.inf)
        leaves = int(ratio.argmin())
        row = inverse[leaves] / change[leaves]
        inverse -= change[:, None] * row
        inverse[leaves] = row
        patterns[leaves] = column
    plan = _dot(inverse, need)
    left = demand.astype(np.int64).copy()
    chosen = []
    for at in np.argsort(-plan, kind="stable"):
        used = patterns[at] > 0
        times = int(min(np.floor(plan[at] + 1e-6), (left[used] // patterns[at][used]).min())) if used.any() else 0
        if times > 0:
            chosen.append((patterns[at].copy(), times))
            left -= patterns[at] * times
    chosen += [(pattern, 1) for pattern in _tight(widths, left, length)]
    return chosen


@dataclass
class Places:
    """Per class, in order of rank: where the pieces of each pattern start, and the sequence and slot they go to."""

    start: list[np.ndarray]
    sequence: list[np.ndarray]
    each: list[np.ndarray]
    slot: list[np.ndarray]


def places(classes: int, plan: list[tuple[np.ndarray, int]]) -> Places:
    rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(classes)]
    ranked, sequence = np.zeros(classes, np.int64), 0
    for pattern, times in plan:
        slot = 0
        for c in np.flatnonzero(pattern):
            n = int(pattern[c])
            rows[c].append((int(ranked[c]), sequence, n, slot))
            ranked[c] += n * times
            slot += n
        sequence += times
    columns = [[np.array([r[k] for r in part], np.int64) for part in rows] for k in range(4)]
    return Places(*columns)


def cut_points(total: int, length: int) -> list[int]:
    """Full sequences, then what is left: in one piece up to half a sequence, else cut at the half."""
    points = [*range(0, total, length), total]
    if points[-1] - points[-2] > length // 2 and points[-1] - points[-2] < length:
        points.insert(-1, points[-2] + length // 2)
    return points


def tokenized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH, digest: bool = False
) -> DataFrame:
    """The pieces of every document: row, doc_id, start, length, doc_tokens and ids (binary, unsigned 32 bits each).

    A document's ids are those of its whole text and ``END_ID``; null texts count as empty. With ``digest`` the ids'
    CRC-32 (ids_crc32) takes their place.
    """
    held = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocabulary).encode
        for batch in text_slices(batches, 6 << 20):
            which, starts, lengths, totals, pieces = [], [], [], [], []
            for i, ids in enumerate(encode_texts(batch.column("text"))):
                ids += END_ID.to_bytes(4, "little")
                total = len(ids) // 4
                for at, end in zip(cuts := cut_points(total, length), cuts[1:]):
                    piece = ids[4 * at : 4 * end]
                    which.append(i)
                    starts.append(at)
                    lengths.append(len(piece) // 4)
                    totals.append(total)
                    pieces.append(zlib.crc32(piece) if digest else piece)
            rows = pa.array(which, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(rows),
                    batch.column("doc_id").take(rows),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(pieces, held[1]),
                ],
                ["row", "doc_id", "start", "length", "doc_tokens", held[0]],
            )
            del which, starts, lengths, totals, pieces, rows
            release_memory()

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(encode, f"row long, doc_id long, start long, length long, doc_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


def packed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (row, start, length and other columns; row and start name a piece) with sequence_id and offset.

    Read several times: store the pieces first. Every piece gets one place; sequences hold at most ``length`` ids,
    from offset 0 without gaps. The numbers of sequences are unique, those of full ones have gaps. No pieces give no rows.
    """
    widths = length_classes(length)
    # the class of a length is the first that is not smaller: a lookup in a table of all lengths
    lookup = np.searchsorted(widths, np.arange(length + 1))
    classed = pieces.withColumn("class", F.element_at(F.lit(lookup.tolist()), (F.col("length") + 1).cast("int")))
    counts = classed.groupBy("class").agg(F.count("*").alias("n")).toPandas()  # at most one row per class
    demand = np.zeros(len(widths), np.int64)
    demand[counts["class"].to_numpy(int)] = counts["n"].to_numpy(np.int64)
    full = len(widths) - 1
    part = np.flatnonzero(demand[:full])
    plan = []
    for pattern, times in cutting_stock(widths[part], demand[part], length):
        wide = np.zeros(len(widths), np.int64)
        wide[part] = pattern
        plan.append((wide, times))
    shared = pieces.sparkSession.sparkContext.broadcast(places(len(widths), plan))

    # a full sequence needs no rank: it takes a number of its own, beyond those of the plan
    used = sum(times for _, times in plan)
    alone = classed.filter(F.col("class") == full).drop("class").withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(used))
    alone = alone.withColumn("offset", F.lit(0).cast("long"))

    # ranks within a class: within a block, and after all pieces of earlier blocks
    blocks = int(demand[:full].sum()) // RANK_BLOCK + 1
    classed = classed.filter(F.col("class") < full)
    blocked = classed.withColumn("block", F.pmod(F.xxhash64("row", "start"), F.lit(blocks)))
    before = blocked.groupBy("class", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(before.select("class", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "rank-blocks")
    inside = Window.partitionBy("class", "block").orderBy("row", "start")
    ranked = blocked.withColumn("rank", F.row_number().over(inside) - 1).join(before, ["class", "block"])
    ranked = ranked.withColumn("rank", (F.col("rank") + F.col("before")).cast("long")).drop("before", "block")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            kind, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for c in np.unique(kind):
                mine = np.flatnonzero(kind == c)
                use = np.searchsorted(at.start[c], rank[mine], side="right") - 1
                inside = rank[mine] - at.start[c][use]
                each = at.each[c][use]
                sequence[mine] = at.sequence[c][use] + inside // each
                slot[mine] = at.slot[c][use] + inside % each
            kept = [n for n in batch.schema.names if n not in ("class", "rank")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(sequence), pa.array(slot)], [*kept, "sequence_id", "slot"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    placed = ranked.select(*pieces.columns, "class", "rank").mapInArrow(place, f"{fields}, sequence_id long, slot long")
    upto = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(upto), F.lit(0)).cast("long")).drop("slot")
    return placed.unionByName(alone)


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece. An empty or null text is one piece of its end id. Repeated
    rows are packed as often as they occur; extra columns are ignored.
    """
    pieces = stored(tokenized(docs, id_col, text_col, vocabulary, length, digest=True), "pieces")
    return packed(pieces, length).drop("row")


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids array<int>) of stored ``tokenized`` pieces, padded to ``length`` except at a power of two."""
    rows = packed(pieces, length)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                if len(ids) & (len(ids) - 1):
                    ids = np.concatenate([ids, np.full(length - len(ids), pad_id, np.int32)])
                out.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(out, pa.list_(pa.int32()))], ["sequence_id", "ids"])

    grouped = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.mapInArrow(join, "sequence_id long, ids array<int>")
