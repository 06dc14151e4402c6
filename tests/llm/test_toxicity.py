"""Kneser-Ney models: probabilities, held-out accuracy on planted words, edge cases."""

import math
import random

from pyspark.sql import functions as F

from tableload.llm import toxicity

SCHEMA = "doc_id long, text string, ratio double, toxic_score string"


def corpus(n=400):
    pick = random.Random(7)
    parts = ["an", "er", "in", "th", "ou", "ly", "st", "ea"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(pick.choice([8, 60, 800]))]
        toxic = i % 5 == 0
        if toxic:
            words[pick.randrange(len(words))] = "zquip" + pick.choice(parts)
        docs.append((i, " ".join(words), 0.0, None))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_texts_are_told_apart(spark):
    data, marks = corpus()
    data += [(1000, None, None, None), (1001, "", None, None), (1002, "123 !!", None, None), (1003, "an er in " * 20_000, None, None)]
    docs, labels = spark.createDataFrame(data, SCHEMA), spark.createDataFrame([*marks, (None, 1), (3, None), (5, 1), (5, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, learn=F.col("doc_id") % 3 != 1)
    out = toxicity.scored(docs, model).collect()
    assert len(out) == len(data)
    truth = dict(marks)
    held = [(truth[r.doc_id], r.score) for r in out if r.doc_id in truth and r.doc_id % 3 == 1]
    assert all((s >= toxicity.THRESHOLD) == bool(t) for t, s in held)
    assert all(0 <= r.score < toxicity.THRESHOLD for r in out if r.doc_id >= 1000)
    kept = toxicity.keep_harmless(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint(d for d, t in marks if t and d % 3 == 1)


def test_labels_of_ids_that_are_not_learnt_do_not_matter(spark):
    data, marks = corpus(120)
    docs = spark.createDataFrame(data, SCHEMA)
    fold = F.col("doc_id") % 3 != 1
    one = toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), fold)
    other = toxicity.train(docs, spark.createDataFrame([(d, t if d % 3 != 1 else 1 - t) for d, t in marks], "doc_id long, toxic int"), fold)
    assert one == other


def test_no_labels_and_no_rows(spark):
    data, _ = corpus(10)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(data, SCHEMA), none)
    assert all(r.score < toxicity.THRESHOLD for r in toxicity.scored(spark.createDataFrame(data, SCHEMA), model).collect())
    assert toxicity.scored(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_equal_counts_give_no_ratio():
    counts = [("^a", 3, 3), ("^ab", 2, 2), ("^b", 1, 1), ("ab$", 2, 2)]
    model = toxicity.kneser_ney(counts)
    assert all(abs(v) < 1e-12 for v in [*model.grams.values(), *model.contexts.values()])


def test_class_probabilities_add_up_to_one():
    counts = [("^a", 5, 1), ("^b", 1, 4), ("^c", 0, 2)]
    model = toxicity.kneser_ney(counts)
    kinds = {g[1:]: 1 for g, _, _ in counts}  # every letter has one kind of context
    shared = {x: (max(1 - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * 3 / 3) / 3 for x in kinds}
    for c in (0, 1):
        total = sum(row[1 + c] for row in counts)
        types = sum(row[1 + c] > 0 for row in counts)
        p = [max(row[1 + c] - toxicity.DISCOUNT, 0) / total + toxicity.DISCOUNT * types / total / 3 for row in counts]
        assert math.isclose(sum(p), 1)
    assert model.grams["^a"] > 0 > model.grams["^b"] and shared


def test_long_texts_are_not_diluted():
    model = toxicity.Model({"^z": 8.0}, {})
    ratios = toxicity.WordRatios(model)
    plain = " ".join("abcdefgh"[i % 8] * (1 + i // 8) for i in range(600))
    assert toxicity.text_ratio(plain + " z", ratios) == toxicity.text_ratio("a z", ratios) == 4.0
    assert toxicity.text_ratio("z", ratios) == 4.0 and toxicity.text_ratio(None, ratios) == 0.0


def test_scattered_and_repeated_words_add_up(spark):
    pick = random.Random(5)
    parts, rude = ["an", "er", "in", "th", "ou", "ly", "st", "ea"], ["zquip", "vrox", "kwump", "jbaff", "xoggy", "qirzu"]
    docs, labels = [], []
    for i in range(800):
        words = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(60)]
        toxic = i % 4 == 0
        for k, word in enumerate(pick.sample(rude, 5) + [rude[0]] if toxic else [pick.choice(rude)] * (i % 2)):
            words[4 + 9 * k] = word  # no two are neighbours
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), learn=F.col("doc_id") % 3 != 1)
    held = [(r.doc_id % 4 == 0, r.score >= toxicity.THRESHOLD) for r in toxicity.scored(frame, model).collect() if r.doc_id % 3 == 1]
    assert sum(t == p for t, p in held) >= 0.95 * len(held)
    ratios = toxicity.WordRatios(toxicity.Model({"^z": 8.0}, {}))
    once, twice = (toxicity.text_ratios(" ".join(["a", "z", "b"] * 10 + ["c", "z"] * k), ratios) for k in (0, 5))
    assert twice[1] > once[1] and twice[2] > once[2]


def test_a_part_above_the_sample_is_learnt_from(spark):
    ids = [r.id for r in spark.range(300_000).filter(F.pmod(F.xxhash64("id"), F.lit(1 << 14)) == 0).collect()]
    docs = spark.createDataFrame([(i, "zquip an er" if k % 2 else "th ou ly") for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels, sample=(1, 1)).grams


def test_shared_counts_come_from_all_texts(spark):
    data, _ = corpus(60)
    data += [(900, None, 0.0, None), (901, "Ünï-zz9zz THE the", 0.0, None)]
    words = {w for _, t, *_ in data for w in toxicity._WORD.findall((t or "").lower())}
    grams = {m[max(0, e - toxicity.ORDER + 1) : e + 1] for m in (f"^{w}$" for w in words) for e in range(1, len(m))}
    pick = random.Random(1)
    asked = sorted({*pick.sample(sorted(grams), 150), "^qx", "xyzzy"})
    expected, got = toxicity.pooled_levels(grams), toxicity.corpus_levels(spark.createDataFrame(data, SCHEMA), "text", asked)
    assert len(got) == toxicity.ORDER - 1
    for (kinds, totals, types), (own_kinds, own_totals, own_types) in zip(expected, got):
        asked = {g[1:] for g in asked if len(g) > 1}
        for g in asked:
            assert own_kinds[g] == kinds.get(g, 0) and own_totals[g[:-1]] == totals.get(g[:-1], 0) and own_types[g[:-1]] == types.get(g[:-1], 0)
    counts = [(g, i % 3, i % 2) for i, g in enumerate(sorted(grams)) if i % 6]
    sampled = [g for g, _, _ in counts]
    assert toxicity.kneser_ney(counts, levels=toxicity.corpus_levels(spark.createDataFrame(data, SCHEMA), "text", sampled)) == toxicity.kneser_ney(counts, levels=expected)
