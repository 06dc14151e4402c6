"""Exact token ids, plans that meet the demand, and sequences that hold every id once."""

import random
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tableload.llm import packing
from tableload.llm.common import stored
from tableload.llm.segments import SegmentEncoder

VOCABULARY = public_tokenizers.path(packing.VOCABULARY)
PARTS = [" ", " ", "a", "The", "don't", "'s", "'", "\n", "\n\n", "\t", "5", "12", ".", "!?", "é", "Ω", "²", "́", "\xa0", " ", "“", "中", "\x1c", "  ", "_", "<|endoftext|>"]


def test_ids_are_those_of_whole_texts():
    pick = random.Random(5)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 14))) for _ in range(8000)]
    encoder, plain = SegmentEncoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert found == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(12))
def test_plans_meet_the_demand_with_little_waste(seed):
    rng = np.random.default_rng(seed)
    widths = packing.length_classes(2048)
    lengths = np.minimum(rng.lognormal(6, 1, int(10 ** rng.uniform(0, 5))).astype(int) + 1, 1024)
    classes = np.searchsorted(widths, lengths)
    demand = np.bincount(classes, minlength=len(widths))
    used = np.flatnonzero(demand)
    plan = packing.cutting_stock(widths[used], demand[used], 2048)
    assert (sum(p * n for p, n in plan) == demand[used]).all()
    assert all(n > 0 and (p * widths[used]).sum() <= 2048 for p, n in plan)
    assert sum(n for _, n in plan) <= -(-widths[classes].sum() // 2048) * 1.01 + 2


def test_plans_end_after_the_session_has_started(spark):
    """A driver that loaded numpy before its JVM started has lost the threads of BLAS: no step may wait for them."""
    rng = np.random.default_rng(3)
    widths = packing.length_classes(2048)
    used = np.arange(len(widths))[5 : len(widths) : 2]
    demand = rng.integers(1, 400, len(used))
    inverses = []
    found, packing.inverted = packing.inverted, lambda m: inverses.append(len(m)) or found(m)
    try:
        with ThreadPoolExecutor(1) as pool:
            plan = pool.submit(packing.cutting_stock, widths[used], demand, 2048).result(timeout=120)
    finally:
        packing.inverted = found
    assert (sum(p * n for p, n in plan) == demand).all()
    assert inverses and min(inverses) > 100  # over 25 rounds and 100 classes


def test_inverse_of_patterns():
    rng = np.random.default_rng(0)
    matrix = rng.integers(0, 9, (120, 120)).astype(float)
    assert np.abs(np.einsum("ij,jk->ik", packing.inverted(matrix), matrix) - np.eye(120)).max() < 1e-6


def test_full_sequences_are_numbered_beside_the_plan(spark):
    rows = [(i, 0, n) for i, n in enumerate([2048] * 50 + [2040, 1024, 1024, 3, 700])]
    pieces = stored(spark.createDataFrame(rows, "row long, start long, length long"), "t")
    got = packing.packed(pieces).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == 55 and all(sum(n for _, n in s) <= 2048 and min(s)[0] == 0 for s in sequences.values())
    assert sum(s == [(0, 2048)] for s in sequences.values()) == 50


def test_knapsack_against_all_patterns():
    widths, values = np.array([3, 5, 7]), np.array([0.3, 0.55, 0.8])
    best = max(0.3 * a + 0.55 * b + 0.8 * c for a in range(9) for b in range(6) for c in range(4) if 3 * a + 5 * b + 7 * c <= 25)
    worth, pattern = packing._knapsack(widths, values, 25)
    assert abs(worth - best) < 1e-9 and abs(pattern @ values - best) < 1e-9 and pattern @ widths <= 25


SCHEMA = "doc_id long, text string, length string, row string"


def rows():
    pick = random.Random(3)
    out = [(i, " ".join(pick.choice(["the", "idea", "zq", "5,", "é"]) for _ in range(pick.choice([0, 1, 30, 400, 3000]))), "x", "y") for i in range(80)]
    return out + [(900, None, None, None), (901, "", None, None), (902, "word " * 30_000, None, None), (None, "no id", None, None), out[0], out[0]]


def test_every_id_lies_in_one_place(spark):
    data = rows()
    plain = Tokenizer.from_file(VOCABULARY)
    got = [r.asDict() for r in packing.packed_documents(spark.createDataFrame(data, SCHEMA)).collect()]
    whole = {}
    for doc, text, *_ in data:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        whole.setdefault(doc, []).append(ids)
    for doc, copies in whole.items():
        ids = copies[0]
        mine = sorted((p for p in got if p["doc_id"] == doc), key=lambda p: p["start"])
        assert sum(p["length"] for p in mine) == len(ids) * len(copies)
        at = 0
        for i in range(0, len(mine), len(copies)):
            for p in mine[i : i + len(copies)]:
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += mine[i]["length"]
    sequences = {}
    for p in got:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_sequences_hold_the_tokens(spark):
    pieces = stored(packing.tokenized(spark.createDataFrame(rows(), SCHEMA), length=64), "pieces")
    out = packing.sequences(pieces, length=64, pad_id=7).collect()
    assert all(len(r.ids) == 64 or len(r.ids) & (len(r.ids) - 1) == 0 for r in out)
    assert sum(len(r.ids) for r in out) < 1.05 * pieces.agg({"length": "sum"}).first()[0] + 128
    assert sum(i == 1 for r in out for i in r.ids) >= len(rows())


def test_no_rows(spark):
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
