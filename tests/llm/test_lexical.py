"""Scores and ranks against a plain loop over all terms."""

import math
import random
import re
from collections import Counter

import pytest

from tableload.llm import lexical

DOCS = "doc_id long, text string, row string, term string"
ITEMS = "item_id long, text string, n string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, top=10):
    found = [(i, d, Counter(terms(t))) for i, (d, t, *_) in enumerate(docs)]
    found = [(i, d, c) for i, d, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, _, c in found)
    df = Counter(t for _, _, c in found for t in c)
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, d, c in found:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = 0
            for t, times in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, i))
        out += [(item, k + 1, None if no else d, -s) for k, (s, no, d, _) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def data(seed=1):
    pick = random.Random(seed)
    words = ["the", "The", "of", "ÉTÉ", "été", "x1", "no.5", "a-b", "naïve", "中文", "don't", "\x85", "\xa0", "İ", *[f"w{i}" for i in range(40)]]
    seps = [" ", "  ", ", ", "\n", "-", "\t", "/", "\x1c"]

    def text(n):
        return "".join(pick.choice(words) + pick.choice(seps) for _ in range(n))

    docs = [(i, text(pick.choice([0, 1, 3, 20, 200])), "x", "y") for i in range(300)]
    docs += [(900, None, None, None), (901, "", None, None), (902, " .,!", None, None), (None, text(30), None, None)]
    docs += [(903, "the " * 30_000 + text(20_000), None, None), docs[5], docs[5], (904, docs[7][1], None, None)]
    items = [(i, text(pick.choice([1, 5, 30])), "z") for i in range(40)]
    items += [(100, None, None), (101, "", None), (102, "unheard zzz", None), (None, text(9), None), items[3], (3, "w1 w1 w1", None)]
    return docs, items


@pytest.mark.parametrize("bound", [lexical.BLOCK_BYTES, 6000, 1500])
def test_ranks_against_a_loop(spark, bound):
    docs, items = data()
    got = lexical.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=bound)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_blocks_hold_no_more_than_their_bound(spark):
    items = spark.createDataFrame(data()[1], ITEMS)
    rows, numbers = lexical.blocks(lexical.item_terms(items), 1500)
    heavy = rows.selectExpr("block", "octet_length(term) + 16 as w").groupBy("block").sum("w").toPandas()
    assert len(numbers) > 1 and heavy["sum(w)"].max() <= 1500
    assert rows.count() == lexical.item_terms(items).count()


def test_many_tasks_give_the_same_ranks(spark):
    docs, items = data(4)
    got = lexical.ranked(spark.createDataFrame(docs, DOCS).repartition(13), spark.createDataFrame(items, ITEMS), top=3)
    expected = brute(docs, items, 3)
    assert sorted([(r.item_id, r.rank, r.score) for r in got.collect()], key=str) == sorted([(a, b, d) for a, b, _, d in expected], key=str)


def test_no_rows(spark):
    docs, items = data()
    none, asked = spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)
    assert lexical.ranked(none, asked).count() == 0
    assert lexical.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0
