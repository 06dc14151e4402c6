"""Measures against plain loops; thresholds against sorted values."""

import random
import re

from pyspark.sql import functions as F

from tableload.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, doc string"


def brute(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            covered.update(p for i in starts for p in range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(covered)


def rows():
    pick = random.Random(2)
    out = []
    for i in range(300):
        words = [pick.choice(["aa", "bé", "c#", "dd\n", "ee  ", "f\x0bg", "h i"]) for _ in range(pick.choice([0, 5, 19, 20, 60, 150]))]
        text = " ".join(words * pick.choice([1, 1, 2]))
        out.append((i, text, pick.choice(["en", "de", None]), pick.choice(["s0", "s0", "s1", None]), "x", "y"))
    out += [(900, None, None, None, None, None), (901, "", "en", "s0", None, None), (902, "word " * 20_000, "en", "s0", None, None)]
    return out + [out[0], out[0]]


def test_measures_and_base_rules(spark):
    data = rows()
    got = quality.judged(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    expected = {}
    for doc, text, *_ in data:
        expected[doc] = brute(text)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_sketches_merge_to_the_counts_of_the_whole(spark):
    measured = quality.text_measures(spark.createDataFrame(rows(), SCHEMA), "doc_id", "lang", "source", "text")
    passed = measured.filter("not base_failed")
    merged = quality.sketches(measured).groupBy("measure").agg(F.sum("n").alias("n"), F.max("bucket").alias("top"))
    for r in merged.collect():
        top = passed.agg(F.max(r.measure)).first()[0]
        assert r.n == passed.count() and top - top // 32 <= r.top <= top


def test_odd_texts_go_and_clean_ones_stay(spark):
    pick = random.Random(3)
    clean = [(i, " ".join(pick.choice(["plain", "words", "of", "usual", "length", f"n{i}", str(j)]) for j in range(60)), "en", "s0") for i in range(200)]
    odd = [(1000 + i, " ".join(f"w{i}{j}%%%" for j in range(60)), "en", "s0") for i in range(20)]
    docs = spark.createDataFrame(clean + odd, "doc_id long, text string, lang string, source string")
    out = quality.keep_quality(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == list(range(200))


def test_sources_have_spreads_of_their_own(spark):
    def text(i, same):  # 20 lines, the first ``same`` + 1 of them alike
        return "\n".join("menu" if j <= same else f"plain{i % 7} line{j} of{i}" for j in range(20))

    rows = [(i, text(i, 0), "en", "s0") for i in range(150)] + [(200 + i, text(i, 9), "en", "s1") for i in range(150)]
    rows += [(400, text(400, 9), "en", "s0"), (401, text(401, 1), "en", "s0"), (402, text(402, 9), "en", "s1")]
    kept = {r.doc_id for r in quality.keep_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {r[0] for r in rows} - kept == {400}


def test_no_rows(spark):
    assert quality.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_odd_rows_of_the_filter(spark):
    """Null texts and base failures go, repeated rows stay or go together, clashing columns are kept."""
    good = " ".join(f"word{i}" for i in range(60))
    data = [(1, good, "en", "s0", "n", "d"), (1, good, "en", "s0", "n", "d"), (2, None, "en", "s0", "n", "d"), (3, "", None, None, "n", "d"), (None, good + " x", None, None, None, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    out = quality.keep_quality(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([data[0], data[1], data[4]], key=str)
    assert quality.keep_quality(spark.createDataFrame([], SCHEMA)).count() == 0
