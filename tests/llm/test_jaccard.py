"""Near duplicates against all pairs of sets."""

import itertools
import random

import numpy as np
import pytest

from tableload.llm import jaccard
from tableload.llm.common import components

SCHEMA = "doc_id long, text string, n long, component_id string"


def shingles(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(data, size, similarity):
    sets = [shingles(t, size) for _, t, *_ in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(data)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= similarity * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    lowest = {}
    for i, (doc, *_) in enumerate(data):
        if doc is not None:
            lowest[root(i)] = min(doc, lowest.get(root(i), doc))
    return sorted(((d, len(s), lowest.get(root(i), d)) for i, ((d, *_), s) in enumerate(zip(data, sets))), key=str)


def corpus(seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [pick.choice(words) for _ in range(30)]
    data, doc = [], 0
    for _ in range(14):
        base = [pick.choice(words) for _ in range(pick.choice([3, 8, 40, 120]))] + (shared if pick.random() < 0.4 else [])
        for _ in range(pick.choice([1, 1, 3, 12])):
            copy = list(base)
            for _ in range(pick.randint(0, 3)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            text = " ".join(copy)
            data.append((doc, text.upper() if pick.random() < 0.2 else text, None, None))
            doc += 1
    data += [(900, None, None, None), (901, "", None, None), (902, " \t\n", None, None), (903, "one", None, None), (904, "ONE", None, None)]
    data += [(905, "é one two three four", None, None), (906, "É one two three four", None, None), (907, "a\x1cb c d e", None, None)]
    return data + [(908, "again and again and again", None, None)] * 2 + [(None, "one", None, None), (None, None, None, None)]


@pytest.mark.parametrize("seed, size, similarity, summary", [(1, 4, 85, 1 << 17), (2, 5, 80, 0), (3, 1, 60, 1 << 17)])
def test_components_are_those_of_all_pairs(spark, seed, size, similarity, summary):
    data = corpus(seed)
    got = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA), size=size, similarity=similarity, summary_keys=summary)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(data, size, similarity)


def test_family_of_near_copies_of_one_text(spark):
    pick = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    data = []
    for i in range(150):
        copy = list(base)
        copy[pick.randrange(200)] = f"u{i}"
        copy[pick.randrange(200)] = f"v{i}"
        data.append((i, " ".join(copy), None, None))
    got = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA), size=4, similarity=85)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(data, 4, 85)


def test_one_row_of_each_group_stays(spark):
    data = corpus(4)
    data += [data[3], (None, *data[3][1:]), (None, *data[3][1:])]  # repeated rows and copies without an id
    docs = spark.createDataFrame(data, SCHEMA)
    out = jaccard.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    best = {}
    for i, _, component in brute([(i, *row[1:]) for i, row in enumerate(data)], 5, 80):
        place = (data[i][0] is None, data[i][0] or 0, i)
        best[component] = min(best.get(component, place), place)
    expected = sorted(str(data[i][:2]) for *_, i in best.values())
    assert sorted(str((r[0], r[1])) for r in out.collect()) == expected
    assert jaccard.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.near_duplicates(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()[0].component_id == 1


def test_difference_of_signatures_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for n, m, both in ((50, 60, 40), (500, 480, 450), (9000, 300, 200), (30_000, 31_000, 29_000)):
        pool = np.unique(rng.integers(0, 2**63, n + m, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        a, b = np.sort(pool[rng.permutation(len(pool))[:n]]), None
        b = np.sort(np.concatenate([rng.permutation(a)[: min(both, m, n)], rng.integers(0, 2**62, m - min(both, m, n)).astype(np.uint64)]))
        least = jaccard._least_difference(jaccard._signature(a), jaccard._signature(b))
        assert least <= len(np.setxor1d(a, b))


def test_components_of_a_chain_a_star_and_a_pair(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 3), (3, 7), (9, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 500 for i in range(500, 560)) and got[3] == got[7] == 3


def test_workers_keep_few_words():
    """A worker's cache is small beside an executor's memory, and what it has dropped changes no set."""
    hashes = jaccard._WordHashes()
    texts = [b" ".join(b"word%d" % i for i in range(k, k + 5_000)) for k in range(0, 300_000, 4_000)]
    sets = [jaccard.shingle_set(text, hashes) for text in texts]
    assert sum(len(k) + 120 for k in hashes) < 20 << 20
    assert all((jaccard.shingle_set(text, jaccard._WordHashes()) == found).all() for text, found in zip(texts, sets))


@pytest.fixture
def meetings(monkeypatch):
    """(rows, distinct pairs) of every join of the second round."""
    seen, plain = [], jaccard._meetings

    def counted(*args):
        pairs = plain(*args)
        seen.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard, "_meetings", counted)
    return seen


def family(pick, members, edits, name="b", length=300):
    """Copies of one text with some words replaced by words of their own."""
    for i in range(members):
        copy = [f"{name}{k}" for k in range(length)]
        for _ in range(pick.choice(edits)):
            copy[pick.randrange(length)] = f"{name}u{i}x{pick.random()}"
        yield " ".join(copy)


def test_pairs_of_a_family_below_the_threshold_meet_about_once(spark, meetings):
    data = [(i, text, None, None) for i, text in enumerate(family(random.Random(6), 40, [7]))]
    got = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA), summary_keys=0)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(data, 5, 80)
    [(rows, pairs)] = meetings
    assert 0 < pairs <= 40 * 39 // 2 and rows < 2 * pairs  # one for each of some twenty shingles before


def test_texts_that_share_a_passage_each_do_not_meet(spark, meetings):
    data = []
    for i in range(24):
        parts = [f"own{i}x{k}" for k in range(150)]
        for j in range(24):
            if i != j:
                parts += [f"p{min(i, j)}x{max(i, j)}w{k}" for k in range(5)] + [f"gap{i}x{j}"]
        data.append((i, " ".join(parts), None, None))
    got = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA))
    assert sorted(r.component_id for r in got.collect()) == list(range(24))
    assert [rows for rows, _ in meetings] == [0]  # those with a passage in both prefixes before


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 8)])
def test_families_around_the_threshold(spark, seed, parts):
    """With one partition the summary knows the shingles of the families, with eight it knows none of them."""
    pick = random.Random(seed)
    texts = [t for name in "abcdef" for t in family(pick, pick.choice([6, 25]), [0, 1, 2, 3, 4, 5, 8], name, pick.choice([60, 200]))]
    texts += [" ".join(f"a{k}" for k in range(n)) for n in range(4, 60, 3)] + [f"{t} {u}" for t, u in zip(texts[::5], texts[3::5])]
    pick.shuffle(texts)
    data = [(i, text, None, None) for i, text in enumerate(texts)]
    got = jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA).repartition(parts))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(data, 5, 80)


def test_places_follow_the_order_of_shingles():
    rng = np.random.default_rng(3)
    tokens = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    for known in (tokens[:0], tokens[::3]):
        counts = rng.integers(8, 40, len(known)) * rng.choice([1, 1 << 31], len(known))
        order = jaccard.prefix_of(tokens, known, counts, 0)
        places = [jaccard._last_place(order[: i + 1], known, counts) for i in range(len(order))]
        assert len(order) == len(tokens) and places == sorted(places) and 0 <= places[0] and places[-1] < 1 << 63
    assert jaccard._last_place(tokens[:0], tokens, tokens) == 0
