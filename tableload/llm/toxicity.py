"""Toxicity by two class-conditional Kneser-Ney models of characters in words.

Both classes have n-gram counts of their own at the highest order and share the lower ones: the continuation counts
of all documents' words, to which unseen expressions back off in either class alike [Kneser and Ney, 1995].
A word's log-likelihood ratio is what the toxic model gives it above the ordinary one. A text has three ratios, each
normalised by length: of its running words as a whole, repeats included; of the most toxic window of ``SENTENCE`` running
words, less what the best of so many windows has by chance; and of the most toxic passage of ``PASSAGE`` distinct words in
order of first use, so that one expression in a long text is not diluted. A logistic curve of the three, fitted on
labelled texts that were not counted, turns them into a score.

Training takes a bounded sample (``SAMPLE`` labelled rows of each class, by hash of the id) for the class counts; the n-grams
of the whole texts of these rows are counted by Spark, without a cutoff. The shared continuation counts need no labels:
they come from the distinct words of all documents, and grow with them. Every document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import array_slices, free_name, release_memory, stored, text_slices

ORDER = 5
DISCOUNT = 0.75
PASSAGE = 2
SENTENCE = 16
SAMPLE = (4_000, 12_000)  # most toxic and ordinary rows to learn from; a quarter of them calibrates
THRESHOLD = 0.7
CACHED_WORDS = 100_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Log ratios of n-grams that either class has, of contexts for all others, and the logistic curve.

    The curve is of the weighted sum of a text's ratios: its passage's, the whole text's and its windows', the last
    less ``chance`` times sqrt(2 log(number of windows)).
    """

    grams: dict[str, float]
    contexts: dict[str, float]
    slope: float = 1.0
    middle: float = 0.0
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    chance: float = 0.0

    def word(self, word: str) -> float:
        text, total = f"^{word}$", 0.0
        for i in range(1, len(text)):
            start = max(0, i - ORDER + 1)
            found = self.grams.get(text[start : i + 1])
            total += self.contexts.get(text[start:i], 0.0) if found is None else found
        return total

    def score(self, ratio: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * (ratio - self.middle)))))


class WordRatios(dict):
    """Ratios of words, kept while there are not too many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = self.model.word(word)
        return value


def text_ratio(text: str | None, ratios: WordRatios, passage: int = PASSAGE) -> float:
    """The largest length-normalised log ratio of a passage of distinct words; 0 without words."""
    words = list(dict.fromkeys(_WORD.findall(text.lower()))) if text else []
    if not words:
        return 0.0
    sums = np.cumsum([0.0, *map(ratios.__getitem__, words)])
    return float((sums[passage:] - sums[:-passage]).max() if len(words) >= passage else sums[-1]) / passage


def text_ratios(text: str | None, ratios: WordRatios) -> tuple[float, float, float, int]:
    """The ratios of the most toxic passage, the whole running text and its most toxic window, and how many windows it has."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return 0.0, 0.0, 0.0, 1
    sums = np.cumsum([0.0, *map(ratios.__getitem__, words)])
    whole, windows = float(sums[-1]) / len(words), max(1, len(words) - SENTENCE + 1)
    best = float((sums[SENTENCE:] - sums[:-SENTENCE]).max()) / SENTENCE if windows > 1 else whole
    return text_ratio(text, ratios), whole, best, windows


def evidence(model: Model, text: str | None, ratios: WordRatios) -> float:
    """The weighted sum of the text's ratios that the curve takes; 0 without words."""
    passage, whole, best, windows = text_ratios(text, ratios)
    return float(np.dot(model.weights, (passage, whole, best - model.chance * math.sqrt(2 * math.log(windows)))))


# Of each order, from the highest: continuation counts of grams, and their sum and number by context.
Levels = list[tuple[dict[str, int], dict[str, int], dict[str, int]]]


def pooled_levels(grams: Iterable[str]) -> Levels:
    """Continuation counts of distinct grams, each order shorter by its first character."""
    levels, grams = [], set(grams)
    while True:
        kinds: dict[str, int] = defaultdict(int)
        for g in grams:
            if len(g) > 1:
                kinds[g[1:]] += 1
        if not kinds:
            return levels
        totals, types = defaultdict(int), defaultdict(int)
        for g, n in kinds.items():
            totals[g[:-1]] += n
            types[g[:-1]] += 1
        levels.append((kinds, totals, types))
        grams = set(kinds)


def kneser_ney(counts: list[tuple[str, int, int]], discount: float = DISCOUNT, levels: Levels | None = None) -> Model:
    """The model of n-gram counts (gram, in toxic texts, in ordinary ones); a gram is its context and one character.

    Grams are of full order, or begin with the word's start. ``levels`` are the shared continuation counts, by default
    those of the counted grams.
    """
    levels = pooled_levels(g for g, _, _ in counts) if levels is None else levels
    letters = max(2, len({g[-1] for g, _, _ in counts}))

    def shared(gram: str, level: int = 0) -> float:
        if not gram or level >= len(levels):
            return 1 / letters
        kinds, totals, types = levels[level]
        lower = shared(gram[1:], level + 1)
        total = totals.get(gram[:-1], 0)
        if not total:
            return lower
        return (max(kinds.get(gram, 0) - discount, 0) + discount * types[gram[:-1]] * lower) / total

    total = (defaultdict(int), defaultdict(int))
    types = (defaultdict(int), defaultdict(int))
    for g, *both in counts:
        for c in (0, 1):
            if both[c]:
                total[c][g[:-1]] += both[c]
                types[c][g[:-1]] += 1

    def left(c: int, context: str) -> float:
        """The share of a class's mass in a context that goes to the shared counts."""
        return discount * types[c][context] / total[c][context] if total[c].get(context) else 1.0

    contexts = {h: math.log(left(0, h)) - math.log(left(1, h)) for h in {*total[0], *total[1]}}
    ratios = {}
    for g, *both in counts:
        back, h, logs = shared(g[1:]), g[:-1], []
        for c in (0, 1):
            own = max(both[c] - discount, 0) / total[c][h] if total[c].get(h) else 0.0
            logs.append(math.log(own + left(c, h) * back))
        ratios[g] = logs[0] - logs[1]
    return Model(ratios, contexts)


def _logistic(x: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes of the columns of ``x`` and the constant of a logistic curve.

    Classes weigh alike, slopes are kept small by a penalty and are not negative: no evidence of toxicity counts against it.
    """
    if not len(x) or toxic.all() or not toxic.any():
        top = float(x[:, 0].max()) if len(x) else 0.0
        return np.array([1.0, *[0.0] * (x.shape[1] - 1)]), -top - 5.0
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum()) * 200
    used = list(range(x.shape[1]))
    while True:
        rows = np.column_stack([x[:, used], np.ones(len(x))])
        small = np.array([*[0.05] * len(used), 1e-9])
        beta = np.zeros(len(used) + 1)
        for _ in range(50):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(np.einsum("ij,j->i", rows, beta), -50, 50)))  # no BLAS: see packing
            down = np.einsum("ij,i->j", rows, weight * (toxic - p)) - small * [*beta[:-1], 0.0]
            bend = np.einsum("ij,i,ik->jk", rows, weight * p * (1 - p), rows) + np.diag(small)
            step = np.linalg.solve(bend, down)
            beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if len(used) == 1 or beta[:-1].min() >= 0:
            break
        used.pop(int(beta[:-1].argmin()))
    slopes = np.zeros(x.shape[1])
    slopes[used] = np.maximum(beta[:-1], 1e-3)
    return slopes, float(beta[-1])


def fit(model: Model, found: np.ndarray, toxic: np.ndarray) -> None:
    """Fit the curve of ``model`` on ``text_ratios`` of texts that were not counted."""
    by_chance = np.sqrt(2 * np.log(found[:, 3]))
    plain = ~toxic & (by_chance > 0)
    if plain.any():  # how far the best window of ordinary texts lies above the text, by the number of windows
        above = ((found[plain, 2] - found[plain, 1]) * by_chance[plain]).sum()
        model.chance = max(0.0, float(above / (by_chance[plain] ** 2).sum()))
    x = np.column_stack([found[:, 0], found[:, 1], found[:, 2] - model.chance * by_chance])
    slopes, constant = _logistic(x, toxic)
    model.slope = float(slopes.sum())
    model.weights = tuple(float(v) for v in slopes / model.slope)
    model.middle = -constant / model.slope


def _ratios(texts: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    """``texts`` with its text's weighted ratio in a new column ``name``: only the texts go to Python."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratios = WordRatios(shared.value)
        for batch in batches:
            found = [evidence(shared.value, t, ratios) for part in array_slices(batch, 2 << 20) for t in part.to_pylist()]
            release_memory()
            yield pa.array(found, pa.float64())

    return texts.withColumn(name, F.arrow_udf(run, "double")(F.col(text_col)))


def _grams(words: DataFrame, *kept: str) -> DataFrame:
    """(gram, ...) of every place in every ``word``: of full order, or from the word's start."""
    at = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("w"), *kept)
    at = at.select("w", *kept, F.explode(F.sequence(F.lit(2), F.length("w"))).alias("end"))
    start = F.greatest(F.lit(1), F.col("end") - ORDER + 1)
    return at.select(F.substring("w", start, F.col("end") - start + 1).alias("gram"), *kept)


def corpus_levels(docs: DataFrame, text_col: str, asked: list[str]) -> Levels:
    """Continuation counts of the distinct words of all texts, for the endings of the ``asked`` grams.

    Every text counts, whatever its label; what comes to the driver is bounded by the asked grams.
    """
    plain = F.regexp_replace(F.lower(F.col(text_col)), r"[^\p{L}]+", " ")
    words = docs.select(F.explode(F.array_distinct(F.split(plain, " "))).alias("word")).filter("word <> ''").distinct()
    kinds, levels = _grams(words).distinct(), []
    while True:
        asked = sorted({g[1:] for g in asked if len(g) > 1})
        if not asked:
            return levels
        endings = kinds.filter("length(gram) > 1").select(F.expr("substring(gram, 2)").alias("gram"))
        kinds = stored(endings.groupBy("gram").agg(F.count("*").alias("n")), "continuations")
        wanted = docs.sparkSession.createDataFrame([(g, g[:-1]) for g in asked], "gram string, context string")
        found = kinds.join(wanted.select("gram"), "gram").collect()
        by_context = kinds.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context")).agg(F.sum("n").alias("n"), F.count("*").alias("types"))
        around = by_context.join(wanted.select("context").distinct(), "context").collect()
        levels.append((defaultdict(int, {r.gram: r.n for r in found}), defaultdict(int, {r.context: r.n for r in around}), defaultdict(int, {r.context: r.types for r in around})))
        kinds = kinds.select("gram")


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: tuple[int, int] = SAMPLE,
) -> Model:
    """A model of the texts of ``docs`` with a label in ``labels`` (doc_id, toxic), where ``learn`` holds.

    Of several labels of one id the largest counts; null ids and labels do not. Without labelled texts every ratio
    is zero.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id is not null and toxic is not null")
    marks = marks.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    if learn is not None:
        marks = marks.withColumnRenamed("id", id_col).filter(learn).withColumnRenamed(id_col, "id")
    marks = marks.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 14)))
    sizes = marks.groupBy("toxic", "part").count().toPandas().sort_values("part")  # at most 2 * 2**14 rows
    bound = F.lit(False)
    for value, most in zip((1, 0), sample):
        own = sizes[sizes["toxic"] == value]
        within = own["part"][own["count"].cumsum() <= max(most, *own["count"].iloc[:1])] if len(own) else own["part"]
        bound = bound | (F.col("toxic") == value) & (F.col("part") <= (int(within.max()) if len(within) else -1))
    picked = marks.filter(bound).select("id", "toxic", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(4)) > 0).alias("counted"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = stored(texts.join(F.broadcast(picked), "id").filter("text is not null"), "toxic-sample")

    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")
    words = chosen.filter("counted").select("toxic", F.explode(F.array_distinct(F.split(plain, " "))).alias("word")).filter("word <> ''")
    words = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    grams = _grams(words, "t", "o").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    counts = list(grams.toPandas().sort_values("gram").itertuples(index=False, name=None))  # of the bounded sample
    model = kneser_ney(counts, levels=corpus_levels(docs, text_col, [g for g, _, _ in counts]))

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = WordRatios(shared.value)
        for batch in text_slices(batches, 2 << 20):
            found = [text_ratios(t, ratios) for t in batch.column("text").to_pylist()]
            release_memory()
            columns = [batch.column("toxic"), *[pa.array([float(r[k]) for r in found]) for k in range(4)]]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "passage", "whole", "best", "windows"])

    tested = chosen.filter("not counted").select("toxic", "text")
    tested = tested.mapInArrow(run, "toxic int, passage double, whole double, best double, windows double").toPandas()
    tested = tested.sort_values(list(tested.columns))
    fit(model, tested.drop(columns="toxic").to_numpy(float), tested["toxic"].to_numpy() == 1)
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with its column ``name`` (0 to 1): the whole text's score; null and empty texts score as harmless."""
    ratio = free_name(docs.columns, "ratio")
    curve = 1 / (1 + F.exp(F.lit(-model.slope) * (F.col(ratio) - F.lit(model.middle))))
    return _ratios(docs, model, text_col, ratio).withColumn(name, curve).drop(ratio)


def keep_harmless(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    score = free_name(docs.columns, "toxic_score")
    return scored(docs, model, text_col, score).filter(F.col(score) < threshold).drop(score)
