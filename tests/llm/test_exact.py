"""Exact de-duplication against grouping by the texts themselves."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tableload.llm.exact import drop_exact_duplicates, exact_duplicates, identities

SCHEMA = "doc_id long, text string, lang string, kept string, row_id int"


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows():
    pick = random.Random(1)
    words = ["a", "B", "É", "é", "x y", "", "\n", "long " * 30]
    texts = ["".join(pick.choice(words) for _ in range(pick.randint(0, 5))) for _ in range(120)]
    out = [(i, t, "en", "clash", 1) for i, t in enumerate(texts)]
    out += [(500, None, None, None, None), (501, "", "en", None, None), (None, "a", "en", None, None), (None, "only null", "en", None, None)]
    out += [(502, "Same", "en", None, None)] * 3 + [(503, "sAME", "en", None, None), (600, "z" * 50_000, "en", None, None), (601, "Z" * 50_000, "en", None, None)]
    return out


@pytest.mark.parametrize("block_bytes, handle_bytes", [(4096, 8), (4, 1), (7, 1)])
def test_groups_are_those_of_equal_texts(spark, block_bytes, handle_bytes):
    data = rows() if block_bytes > 100 else [r for r in rows() if len(r[1] or "") < 1000]
    got = exact_duplicates(spark.createDataFrame(data, SCHEMA), block_bytes=block_bytes, handle_bytes=handle_bytes).collect()
    groups = {}
    for doc, text, *_ in data:
        groups.setdefault(normal(text), []).append(doc)
    assert len(got) == len(data)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = {}
    for r in got:
        ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None)
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_rows_that_stay_keep_their_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    texts = [normal(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in rows()})


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_duplicates(empty).count() == 0 and drop_exact_duplicates(empty).count() == 0


def test_names_differ_where_bodies_differ(spark):
    bodies = [(i, bytearray(f"{i % 13:02d}" * (1 + i % 9), "ascii")) for i in range(200)]
    got = identities(spark.createDataFrame(bodies, "row_id long, body binary"), block_bytes=3, handle_bytes=1)
    names = {r.row_id: (r.n_blocks, r.name) for r in got.collect()}
    for i, a in bodies:
        for j, b in bodies[: i + 1]:
            assert (names[i] == names[j]) == (a == b)


def test_plan_has_no_python(spark, plan):
    text = plan(exact_duplicates(spark.createDataFrame(rows(), SCHEMA)).select(F.max("keep_id")))
    assert "Python" not in text and "Arrow" not in text
