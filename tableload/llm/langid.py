"""Language identification by bit-sliced Bloom filters of character n-grams.

Each language has a Bloom filter of the n-grams of its training texts. The filters lie side by side: slot i of all of
them is one row of bits, so that reading an n-gram's slots once and intersecting the rows gives the set of all
languages that contain it. A text's languages are counted by the bits of its n-grams; each count is corrected for
the share of n-grams that a filter of that fill takes for its own, and the largest corrected count decides.

Training takes a bounded sample (``SAMPLE`` labelled rows of a language, by hash of the id), whole texts; n-grams that
fewer than ``MIN_TEXTS`` texts of a language have are left out, unless the language has few texts. Every document is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import text_slices

GRAM = 4
SLOT_BITS = 20  # a filter has 2**20 slots
HASHES = 3
SAMPLE = 2_000
FEW_TEXTS = 100  # a language with fewer learnt texts keeps all its n-grams
MIN_TEXTS = 2
UNDETERMINED = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of texts in order, where each text's begin and end, and how many letters each text has.

    N-grams lie within a lower-cased word and the gaps before and after it.
    """
    texts = [t.lower() for t in texts]
    joined = "".join(["\0" + t for t in texts]) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    keep = letter | (codes == 0)
    keep[1:] |= letter[:-1]  # one gap after a word, and the border before each text
    borders = np.concatenate([[0], np.cumsum([1 + len(t) for t in texts])]).astype(np.int64)
    kept = np.concatenate([[0], np.cumsum(keep)])
    inside = np.where(letter, codes, 0)[keep].astype(np.uint64)
    lettered = np.concatenate([[0], np.cumsum(letter)])
    n = len(inside) - GRAM + 1
    valid = np.ones(max(n, 0), bool)
    hashes = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM):
        part = inside[i : i + max(n, 0)]
        hashes += (part + np.uint64(1)) * _FACTORS[i]
        if 0 < i < GRAM - 1:
            valid &= part > 0
    hashes ^= hashes >> np.uint64(31)
    hashes *= _FACTORS[1]
    hashes ^= hashes >> np.uint64(29)
    upto = np.concatenate([[0], np.cumsum(valid)])
    return hashes[valid], upto[np.minimum(kept[borders], max(n, 0))], np.diff(lettered[borders])


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - SLOT_BITS)
    return [(hashes * _FACTORS[i] >> shift).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    languages: list[str]
    rows: np.ndarray  # (slots, words) of 64 languages each
    false_share: np.ndarray  # of foreign n-grams that a language's filter takes for its own

    def counts(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Corrected counts (texts, languages) of the n-grams between the ends."""
        n = np.diff(ends)
        out = np.zeros((len(n), len(self.languages)))
        at = slots(hashes)
        for word in range(self.rows.shape[1]):
            masks = self.rows[at[0], word]
            for more in at[1:]:
                masks = masks & self.rows[more, word]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                hits = np.concatenate([[0], np.cumsum((masks >> np.uint64(bit) & np.uint64(1)).astype(np.int64))])
                out[:, 64 * word + bit] = hits[ends[1:]] - hits[ends[:-1]]
        return np.maximum(out - n[:, None] * self.false_share, 0) / np.maximum(1 - self.false_share, 1e-9)


def train(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Filters:
    """Filters of the languages that occur in ``docs`` where ``learn`` holds and language and text are not null."""
    rows = docs if learn is None else docs.filter(learn)
    rows = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(id_col), F.lit(1 << 12)).alias("part")
    )
    sizes = rows.groupBy("lang", "part").count().toPandas().sort_values(["lang", "part"])  # at most 2**12 rows a language
    languages = sorted(sizes["lang"].unique())
    bound, known = F.lit(False), []
    for lang in languages:
        own = sizes[sizes["lang"] == lang]
        within = own["part"][own["count"].cumsum() <= max(sample, int(own["count"].iloc[0]))]
        bound = bound | (F.col("lang") == lang) & (F.col("part") <= int(within.max()))
        known.append(lang)
    number = {lang: i for i, lang in enumerate(known)}

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            which = np.array([number[x] for x in batch.column("lang").to_pylist()])
            hashes, ends, _ = gram_hashes(batch.column("text").to_pylist())
            text = np.repeat(np.arange(len(which)), np.diff(ends))
            pairs = np.unique(np.stack([text.astype(np.uint64), hashes], axis=1), axis=0)  # once per text
            lang = which[pairs[:, 0].astype(np.int64)].astype(np.uint64)
            found, n = np.unique(np.stack([lang, pairs[:, 1]], axis=1), axis=0, return_counts=True)
            columns = [found[:, 0].astype(np.int32), np.ascontiguousarray(found[:, 1]).view(np.int64), n.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "gram", "n"])

    words = max(1, -(-len(known) // 64))
    table = np.zeros((1 << SLOT_BITS, words), np.uint64)
    if known:
        grams = rows.filter(bound).select("lang", "text").mapInArrow(collect, "lang int, gram long, n long")
        few = [number[lang] for lang, n in sizes.groupby("lang")["count"].sum().items() if n < FEW_TEXTS]
        grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter((F.col("n") >= MIN_TEXTS) | F.col("lang").isin(few))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lang = batch.column("lang").to_numpy()
                for at in slots(batch.column("gram").to_numpy().view(np.uint64)):
                    bits = np.left_shift(np.uint64(1), (lang % 64).astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array((lang // 64).astype(np.int32)), pa.array(at), pa.array(bits)], ["word", "slot", "bits"])

        placed = grams.select("lang", "gram").mapInArrow(place, "word int, slot long, bits long")
        filled = placed.groupBy("word", "slot").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most one row per slot
        table[filled["slot"].to_numpy(), filled["word"].to_numpy()] = filled["bits"].to_numpy(np.int64).view(np.uint64)
    bits = np.arange(len(known))
    fill = np.array([(table[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)).mean() for b in bits])
    return Filters(known, table, fill**HASHES)


def identified(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``; the score is the language's share of the corrected counts.

    Texts that are null or have no letter are undetermined, with score 0. A text without a known n-gram gets the first
    language with score 0; ties go to the first language by name. Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], dtype=object)
        for batch in text_slices(batches, 4 << 20):
            hashes, ends, letters = gram_hashes([t or "" for t in batch.column("text").to_pylist()])
            counts = known.counts(hashes, ends)
            total = counts.sum(axis=1)
            best = counts.argmax(axis=1) if len(known.languages) else np.zeros(len(total), np.int64)
            top = counts.max(axis=1) if len(known.languages) else total
            best = np.where(letters > 0, best, len(known.languages))
            score = np.where((letters > 0) & (total > 0), top / np.where(total > 0, total, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
