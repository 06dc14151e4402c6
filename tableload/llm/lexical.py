"""Ranked lexical search: documents for items (queries), scored straight from the texts, without an index of documents.

The distinct terms of all items make one Aho-Corasick automaton. A text is folded byte by byte (A-Z lower-cased, every
separator a guard), and each term stands in the automaton between two guards, so that only whole terms match [Aho and
Corasick, 1975]. One scan gives every document's length and the counts of the terms that items have; these counts are
stored. Corpus figures follow from them, and with these each term that was put out maps to its items: a task adds up the
scores of its documents and keeps the best of each item, so that a few rows an item and task are shuffled.

Items are cut into blocks of at most ``BLOCK_BYTES`` of terms, one broadcast and one scan each: what is broadcast does not
grow with the items. An item with more terms than a block holds is cut too; its parts' scores are then added up
per document by a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tableload.llm.common import lower_ascii, stored, text_slices

TOP = 10
BLOCK_BYTES = 4 << 20  # of the terms of the items in a block, and 16 for each term of each item
CELLS = 1 << 20  # scores of documents times items that a task holds at a time
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# bytes of UTF-8: separators to the guard, A-Z lower-cased, all else as it is
FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


@dataclass
class Block:
    """The terms of some items; of term i the items ``items[starts[i]:starts[i + 1]]`` hold it ``times`` often."""

    terms: list[str]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    ids: list[int | None]  # of the items
    parts: np.ndarray  # whether an item has terms in other blocks too
    weights: np.ndarray | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def folded(text: bytes) -> bytes:
    """A text as the automaton reads it, between guards."""
    return b" " + text.translate(FOLD) + b" "


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Finds whole terms in folded texts; the value of a match is the term's number."""
    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word(folded(term.encode()).decode("latin-1"), i)  # one character per byte
    out.make_automaton()
    return out


_automata: dict[str, ahocorasick.Automaton] = {}


def _kept_automaton(block: Block) -> ahocorasick.Automaton:
    """This worker's automaton: tasks that follow one another build it once."""
    if block.name not in _automata:
        _automata.clear()
        _automata[block.name] = automaton(block.terms)
    return _automata[block.name]


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term, times): the terms of the texts of one id, together. Null texts and texts without terms have none."""
    words = F.split(lower_ascii(F.col(text_col)), SEPARATORS)
    rows = items.select(F.col(id_col).cast("long").alias("item"), F.explode(words).alias("term")).filter("term <> ''")
    return rows.groupBy("item", "term").agg(F.count("*").alias("times"))


def blocks(terms: DataFrame, most: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """``item_terms`` with ``block`` and ``parts`` (blocks that an item may be spread over), and the blocks' numbers.

    A block weighs at most ``most``, unless it is one part of one item that a single term makes too large.
    """
    weighed = terms.withColumn("weight", F.octet_length("term") + 16)
    sizes = weighed.groupBy("item").agg(F.sum("weight").alias("size")).withColumn("parts", F.ceil(F.col("size") * 4 / most).cast("long"))
    weighed = weighed.join(sizes.withColumnRenamed("item", "i"), F.expr("item <=> i")).drop("i", "size")
    weighed = stored(weighed.withColumn("part", F.expr("pmod(xxhash64(term), parts)")), "item-terms")
    total = weighed.agg(F.sum("weight")).first()[0]
    count = -(-int(total or 0) * 2 // most) if total and total > most else 1
    while True:
        out = weighed.withColumn("block", F.pmod(F.xxhash64("item", "part"), F.lit(count)))
        heavy = out.groupBy("block").agg(F.sum("weight").alias("w"), F.count_distinct("item", "part").alias("n"))
        if heavy.filter(f"w > {most} and n > 1").isEmpty():
            return out.select("item", "term", "times", "parts", "block"), sorted(r.block for r in heavy.select("block").collect())
        count *= 2


def gathered(rows: DataFrame) -> Block:
    """One block of ``blocks`` in the driver."""
    found = rows.select("term", "item", "times", "parts").orderBy("term", "item").collect()  # bounded by BLOCK_BYTES
    ids = sorted({r.item for r in found}, key=lambda x: (x is None, x))
    place = {item: i for i, item in enumerate(ids)}
    terms = list(dict.fromkeys(r.term for r in found))
    number = {term: i for i, term in enumerate(terms)}
    parts = np.zeros(len(ids), bool)
    for r in found:
        parts[place[r.item]] = r.parts > 1
    counts = np.bincount([number[r.term] for r in found], minlength=len(terms)) if found else np.zeros(0, np.int64)
    return Block(
        terms,
        np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
        np.array([place[r.item] for r in found], np.int64),
        np.array([r.times for r in found], np.int64),
        ids,
        parts,
    )


def term_counts(docs: DataFrame, block: Block) -> DataFrame:
    """(row, doc_id, n, terms, tfs) of every document (row, doc_id, text) with a term: its length in terms, and the block's
    terms in it. Stored."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _kept_automaton(shared.value)
        size = len(shared.value.terms)
        for batch in text_slices(batches):
            lengths, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = folded(text or b"")
                lengths.append(len(text.split()))  # of bytes: only guards are white space
                if size and lengths[-1]:
                    hits = np.fromiter((v for _, v in found.iter(text.decode("latin-1"))), np.int64)
                    kinds, n = np.unique(hits, return_counts=True)
                    terms.append(kinds)
                    tfs.append(n)
                    ends.append(ends[-1] + len(kinds))
                else:
                    ends.append(ends[-1])
            ends = pa.array(ends, pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), t))
                for c, t in ((terms, pa.int32()), (tfs, pa.int64()))
            ]
            rows = pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], ["row", "doc_id", "n", "terms", "tfs"]
            )
            yield rows.filter(pa.array(np.array(lengths) > 0))

    return stored(docs.mapInArrow(scan, "row long, doc_id long, n long, terms array<int>, tfs array<long>"), "term-counts")


def weights(counts: DataFrame, documents: int, size: int) -> np.ndarray:
    """The weight of each term of a block, by the number of documents that hold it; at most one row a term comes back."""
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    held = held.select("term", F.expr(f"cast(floor(1000 * ln((2 * {documents} + 2) / (2 * df + 1))) as long)").alias("w"))
    out = np.zeros(size, np.int64)
    for r in held.collect():
        out[r.term] = r.w
    return out


class Best:
    """The best documents of each item so far: the highest scores, ties by doc_id (null last), then row."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)  # no lower score can enter
        self.rows = np.zeros((5, 0), np.int64)  # item, score, whether the id is null, doc_id, row

    def add(self, scores: np.ndarray, no_id: np.ndarray, doc: np.ndarray, row: np.ndarray, whole: np.ndarray) -> None:
        at, item = np.nonzero((scores >= self.least) & whole)
        new = np.array([item, scores[at, item], no_id[at], doc[at], row[at]], np.int64)
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[4], rows[3], rows[2], -rows[1], rows[0]))]
        items, first = np.unique(rows[0], return_index=True)
        rank = np.arange(rows.shape[1]) - np.repeat(first, np.diff([*first, rows.shape[1]]))
        self.rows = rows[:, rank < self.top]
        last = rank[rank < self.top] == self.top - 1
        self.least[self.rows[0, last]] = self.rows[1, last]


def _scored(counts: DataFrame, block: Block, documents: int, total: int, top: int) -> DataFrame:
    """(item, whole, doc_id, row, score): the best of each item of the block in each task; all scores of parts of items."""
    shared = counts.sparkSession.sparkContext.broadcast(block)

    def out(block: Block, rows: np.ndarray, whole: bool) -> pa.RecordBatch:
        ids = [block.ids[i] for i in rows[0]]
        columns = [pa.array(ids, pa.int64()), pa.array([whole] * len(ids), pa.bool_())]
        columns += [pa.array(rows[3], mask=rows[2] > 0), pa.array(rows[4]), pa.array(rows[1])]
        return pa.RecordBatch.from_arrays(columns, ["item", "whole", "doc_id", "row", "score"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        items = len(block.ids)
        best, step = Best(items, top), max(1, CELLS // max(items, 1))
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, step):
                batch = whole_batch.slice(start, step)
                n = batch.column("n").to_numpy()
                m = 100 - 75 + (75 * n * documents) // total
                terms, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy()
                sizes = np.diff(terms.offsets.to_numpy())
                terms = terms.flatten().to_numpy()
                at = np.repeat(np.arange(len(n)), sizes)
                worth = block.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[at]))
                held = block.starts[terms + 1] - block.starts[terms]  # items of each match
                place = np.repeat(block.starts[terms] - np.concatenate([[0], np.cumsum(held)[:-1]]), held) + np.arange(held.sum())
                scores = np.zeros(len(n) * items, np.int64)
                np.add.at(scores, np.repeat(at, held) * items + block.items[place], np.repeat(worth, held) * block.times[place])
                scores = scores.reshape(len(n), items)
                doc = batch.column("doc_id")
                no_id, doc, row = doc.is_null().to_numpy(False), doc.fill_null(0).to_numpy(), batch.column("row").to_numpy()
                best.add(scores, no_id, doc, row, ~block.parts)
                if block.parts.any():
                    d, item = np.nonzero((scores > 0) & block.parts)
                    yield out(block, np.array([item, scores[d, item], no_id[d], doc[d], row[d]]), False)
        yield out(block, best.rows, True)

    return counts.mapInArrow(score, "item long, whole boolean, doc_id long, row long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    top: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0, best first, ties by doc_id.

    Rows of ``docs`` are documents of their own, repeated ones too (they rank one after the other); texts of repeated
    item ids count together, and a null id is an id. Null and empty texts have no terms: such documents are not
    counted, such items have no rows. Null doc_ids rank last among equal scores. Without documents or items there are
    no rows. Extra columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    terms, numbers = blocks(item_terms(items, item_col, item_text_col), block_bytes)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if len(numbers) > 1:
        terms = stored(terms, "blocks")
        if not terms.filter("parts > 1").isEmpty():
            rows = stored(rows, "numbered")  # scores of an item's parts are added up by row, so its number is fixed first
    found = []
    for number in numbers:
        block = gathered(terms.filter(F.col("block") == number))
        counts = term_counts(rows, block)
        documents, total = counts.agg(F.count("*"), F.sum("n")).first()
        if documents:
            block.weights = weights(counts, documents, len(block.terms))
            found.append(_scored(counts, block, documents, total, top))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    scores = found[0]
    for frame in found[1:]:
        scores = scores.unionByName(frame)
    if len(numbers) > 1:
        parts = scores.filter("not whole").groupBy("item", "row").agg(F.first("doc_id").alias("doc_id"), F.sum("score").alias("score"))
        scores = scores.filter("whole").drop("whole").unionByName(parts)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    best = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
