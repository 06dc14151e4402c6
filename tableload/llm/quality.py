"""Quality rules with thresholds learnt from the corpus, per language and source.

Every text is measured once. The measures of documents that pass two base rules are counted into log-linear
buckets (exact below 64, then six leading bits, an error of at most 1/32): a quantile sketch that merges by adding
counts, so that it does not depend on the order or number of tasks [as in Masson, Rim and Lee, 2019]. A sketch is
kept per language and source and merged to languages and to the whole corpus; a group of too few documents takes
the thresholds of the next larger one. A threshold is the median plus or minus ``FENCE`` times the distance of the
group's own quartiles, or an upper quantile of the group if that is larger. Thresholds are a small written table that the measured documents are joined with: Spark broadcasts it
if its size in bytes permits, else it joins by shuffle, splitting a hot source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import array_slices, release_memory, stored

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 100  # documents
FENCE = 4
# measure (thousandths): whether low values fail too, the share (percent) of a group's own documents that stays whatever the
# quartiles say, and what one unit of a text adds to the measure: one symbol, one line, one repeated passage, one word
MEASURES = {
    "symbols_pm": (False, 75, "1000 / greatest(word_chars, 1)"),
    "dup_lines_pm": (False, 98, "1000 / greatest(n_lines, 1)"),
    "repeat_pm": (False, 98, f"{2000 * WINDOW} / greatest(n_words, 1)"),
    "word_length_pm": (True, 75, "word_length_pm / greatest(n_words, 1)"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows found twice or more in the text, the first ones included; ``window`` a power of two."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    names = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    span = 1
    while span < window:  # the name of a window is the name of the pair of its halves
        pairs = names[:-span] * (n + 1) + names[span:]
        found, names = np.unique(pairs, return_inverse=True)
        span *= 2
        if len(found) == len(pairs):
            return 0
    starts = np.flatnonzero(np.bincount(names)[names] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``COUNTS`` of whole texts: only texts come to Python, and only numbers go back."""
    for texts in batches:
        slices = [_counts(part) for part in array_slices(texts.cast(pa.string()), 2 << 20)]
        release_memory()  # also what earlier stages have left in the worker
        yield pa.concat_arrays(slices) if slices else pa.array([], pa.struct([(c, pa.int64()) for c in COUNTS]))


def _counts(column: pa.Array) -> pa.Array:
    points = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    rows = np.zeros((len(column), len(COUNTS)), np.int64)
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if not text:
            continue
        words = text.split()  # of bytes: ASCII white space only
        lines = [line for line in text.split(b"\n") if line.strip()]
        rows[i] = (
            len(words),
            points[i] - len(text) + len(text.translate(None, SPACES)),
            len(text) - len(text.translate(None, SYMBOLS)),
            len(lines),
            len(lines) - len(set(lines)),
            repeated_words(words),
        )
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], list(COUNTS))


def _with_measures(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the counts of ``text``, base_failed and the measures."""
    counts = F.arrow_udf(_measure, ", ".join(f"{c} long" for c in COUNTS))(text)
    counted = docs.withColumn("counts", counts).select("*", "counts.*").drop("counts")

    def per_mille(part: str, whole: str) -> Column:
        return F.expr(f"1000 * {part} div greatest({whole}, 1)")

    return counted.withColumns(
        {
            "base_failed": F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
            "symbols_pm": per_mille("n_symbols", "word_chars"),
            "dup_lines_pm": per_mille("n_dup_lines", "n_lines"),
            "repeat_pm": per_mille("n_repeat_words", "n_words"),
            "word_length_pm": per_mille("word_chars", "n_words"),
        }
    )


def text_measures(docs: DataFrame, id_col: str, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """doc_id, lang, source, the counts of the whole text, base_failed and the measures. Stored."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    return stored(_with_measures(rows, F.col("text")).drop("text"), "measures")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) of the documents that pass the base rules: mergeable by adding n."""
    pairs = F.explode(F.create_map(*[x for m in MEASURES for x in (F.lit(m), F.col(m))]))
    long = measured.filter("not base_failed").select("lang", "source", pairs.alias("measure", "value"))
    shift = F.greatest(F.length(F.bin("value")) - 6, F.lit(0))
    bucket = F.expr("shiftleft(shiftright(value, shift), shift)")
    return long.withColumn("shift", shift).groupBy("lang", "source", "measure", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Thresholds (size, fences as a map measure -> lo, hi) of the sketches merged to ``keys``.

    The distance of the quartiles, to the end of the upper one's bucket, counts however small, and ``hi`` is at least the quantile
    of ``MEASURES``.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    part = ", ".join([*keys, "measure"])
    ranked = merged.selectExpr(
        "*",
        f"sum(n) over (partition by {part} order by bucket) as upto",
        f"sum(n) over (partition by {part}) as size",
    )
    at = {q: F.min(F.when(F.col("upto") * 100 >= F.col("size") * q, F.col("bucket"))) for q in sorted({25, 50, 75, *(q for _, q, _ in MEASURES.values())})}
    out = ranked.groupBy(*keys, "measure").agg(F.max("size").alias("size"), *[c.alias(f"q{q}") for q, c in at.items()])
    top = "q75 + shiftleft(1L, greatest(length(bin(q75)) - 6, 0)) - 1"  # the largest value in the bucket
    out = out.withColumn("spread", FENCE * F.expr(f"{top} - q25"))
    tail = F.create_map(*[x for m, (_, q, _) in MEASURES.items() for x in (F.lit(m), F.col(f"q{q}"))])
    hi = F.greatest(F.expr("q50 + spread"), F.element_at(tail, F.col("measure")))
    pair = F.struct(F.expr("q50 - spread").alias("lo"), hi.alias("hi"))
    return out.groupBy(*keys).agg(F.max("size").alias("size"), F.map_from_entries(F.collect_list(F.struct("measure", pair.alias("f")))).alias("fences"))


def thresholds(measured: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, level, fences) for every language and source. Stored."""
    sketch = stored(sketches(measured), "sketches")
    groups = measured.select("lang", "source").distinct().alias("g")
    fine, lang, whole = (_fences(sketch, keys) for keys in (["lang", "source"], ["lang"], []))
    out = (
        groups.join(fine.alias("f"), F.expr("g.lang <=> f.lang and g.source <=> f.source"), "left")
        .join(lang.alias("l"), F.expr("g.lang <=> l.lang"), "left")
        .join(F.broadcast(whole.alias("w")), F.lit(True), "left")  # one row
        .withColumn("level", F.when(F.col("f.size") >= min_group, "source").when(F.col("l.size") >= min_group, "language").otherwise("all"))
    )
    fences = F.when(F.col("level") == "source", F.col("f.fences")).when(F.col("level") == "language", F.col("l.fences")).otherwise(F.col("w.fences"))
    return stored(out.select("g.lang", "g.source", "level", fences.alias("fences")), "thresholds")


def _judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows with measures joined with the thresholds of their language and source: all columns, level and kept."""
    fine = F.lit(True)
    for measure, (low_fails, _, unit) in MEASURES.items():
        fence = F.element_at("t.fences", F.lit(measure))
        shift = f"greatest(length(bin({measure})) - 6, 0)"
        value = F.expr(f"shiftleft(shiftright({measure}, {shift}), {shift})")
        fine = fine & (value - F.expr(unit) <= fence["hi"])
        if low_fails:
            fine = fine & (value + F.expr(unit) >= fence["lo"])
    joined = measured.alias("m").join(limits.alias("t"), F.expr("m.lang <=> t.lang and m.source <=> t.source"), "left")
    return joined.select("m.*", "level", (~F.col("base_failed") & F.coalesce(fine, F.lit(True))).alias("kept"))


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, source, the counts, base_failed, level and kept.

    Words are runs of anything but ASCII white space. A null, empty or blank text has no words and fails. Null
    languages and sources are groups of their own. Rows count as often as they occur. Extra columns are ignored,
    and an empty table gives no rows. A value is rounded to its bucket as the sketch's are, and may exceed a threshold by one
    unit of its text.
    """
    measured = text_measures(docs, id_col, lang_col, source_col, text_col)
    return _judged(measured, thresholds(measured, min_group)).select("doc_id", "lang", "source", *COUNTS, "base_failed", "level", "kept")


def keep_quality(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_group: int = MIN_GROUP
) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns; rows count as often as they occur.

    Texts are measured once for the thresholds and once for the verdict, so that no copy of the documents is stored.
    """
    measured = text_measures(docs, lang_col, lang_col, source_col, text_col)
    limits = thresholds(measured, min_group)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
    )
    again = _with_measures(rows, F.col("doc").getField(text_col))
    return _judged(again, limits).filter("kept").select("doc.*")
