"""Language filters: held-out accuracy, membership against sets, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tableload.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string"


def corpus():
    pick = random.Random(11)
    parts = {"aa": ["tion", "ing", "the", "wh"], "bb": ["schaft", "ung", "ei", "zu"], "cc": ["мир", "дом", "лес", "ок"], "dd": ["eau", "oui", "èr", "ç"]}
    out = []
    for i in range(400):
        lang = pick.choice(list(parts))
        words = ["".join(pick.choice(parts[lang]) for _ in range(pick.randint(1, 3))) for _ in range(pick.choice([2, 30, 500]))]
        out.append((i, " ".join(words).title(), lang, "x", "y"))
    return out


def test_held_out_documents(spark):
    data = corpus()
    odd = [(1000, None, "aa", None, None), (1001, "", "bb", None, None), (1002, "12 ?! 3", "aa", None, None), (1003, "x", None, None, None), (1004, "the\0the the", None, None, None)]
    docs = spark.createDataFrame(data + odd, SCHEMA)
    out = {r.doc_id: r for r in langid.identified(docs, langid.train(docs, learn=F.col("doc_id") % 4 != 2)).collect()}
    truth = {d: lang for d, _, lang, *_ in data}
    held = [out[d].lang_pred == lang for d, lang in truth.items() if d % 4 == 2]
    assert sum(held) > 0.97 * len(held)
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1000].score == 0
    assert out[1003].lang_pred in parts() and out[1004].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in out.values())


def parts():
    return {"aa", "bb", "cc", "dd"}


def test_grams_against_a_plain_loop():
    texts = ["Ab cde, f", "", "  xyz", "a\0bcd", "éé--ÉÉ", "12"]
    hashes, ends, letters = langid.gram_hashes(texts)

    def plain(text):
        words, word = [], ""
        for c in text.lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                words.append(word)
                word = ""
        return sum(max(0, len(w) + 2 - langid.GRAM + 1) for w in words)

    assert np.diff(ends).tolist() == [plain(t) for t in texts]
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in texts]
    alone = langid.gram_hashes(["xyz"])[0].tolist()
    assert hashes[ends[2] : ends[3]].tolist() == alone


def test_popcounts_are_corrected_for_foreign_grams():
    table = np.full((1 << langid.SLOT_BITS, 1), 2, np.uint64)  # the second filter is full, the first empty
    filters = langid.Filters(["a", "b"], table, np.array([0.0, 1.0]))
    hashes, ends, _ = langid.gram_hashes(["some words here"])
    assert filters.counts(hashes, ends)[0].tolist() == [0.0, 0.0]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA)
    assert langid.identified(docs, langid.train(docs)).collect()[0].lang_pred == "und"
    assert langid.identified(spark.createDataFrame([], SCHEMA), langid.train(docs)).count() == 0


def test_a_language_with_one_text_is_learnt(spark):
    pick = random.Random(6)
    words = {lang: ["".join(pick.choice(letters) for _ in range(6)) for _ in range(300)] for lang, letters in (("aa", "abcdefgh"), ("bb", "stuvwxyz"))}
    rows = [(i, " ".join(pick.choice(words["aa"]) for _ in range(80)), "aa") for i in range(40)]
    rows += [(100, " ".join(pick.choice(words["bb"]) for _ in range(3000)), "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.train(docs)
    more = spark.createDataFrame([(100, rows[-1][1]), (101, " ".join(words["bb"][:50])), (102, " ".join(words["aa"][:50]))], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(more, filters).collect()}
    assert {k: v[0] for k, v in got.items()} == {100: "bb", 101: "bb", 102: "aa"} and got[100][1] > 0.9


def test_predictions_are_those_of_exact_sets(spark):
    """The same rule on sets of n-grams, without false positives; only near ties may fall differently."""
    data = corpus()
    docs = spark.createDataFrame(data, SCHEMA)
    filters = langid.train(docs, learn=F.col("doc_id") % 4 != 2)
    sets = {}
    for lang in sorted({r[2] for r in data}):
        seen = {}
        texts = [r[1] for r in data if r[2] == lang and r[0] % 4 != 2]
        for text in texts:
            for gram in set(langid.gram_hashes([text])[0].tolist()):
                seen[gram] = seen.get(gram, 0) + 1
        sets[lang] = {g for g, n in seen.items() if n >= langid.MIN_TEXTS or len(texts) < langid.FEW_TEXTS}
    got = {r.doc_id: r.lang_pred for r in langid.identified(docs, filters).collect()}
    differ = 0
    for doc, text, *_ in data:
        grams = langid.gram_hashes([text])[0].tolist()
        counts = sorted(((sum(g in own for g in grams), lang) for lang, own in sets.items()), key=lambda c: (-c[0], c[1]))
        if counts[0][0] > counts[1][0] + max(1, len(grams) // 50):
            assert got[doc] == counts[0][1], doc
        else:
            differ += 1
    assert differ < len(data) / 20
