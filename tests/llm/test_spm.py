"""Parity with the sentencepiece library: the given BPE model, and a unigram model made of its pieces."""

import random
import struct
from array import array

import public_tokenizers
import pytest
import sentencepiece

from tableload.llm import spm

PARTS = [" ", "  ", "a", "the", "é", "ß", "\n", "\t", "²", ".", "5", "12", "Ω", "中", "́", "word", "　", "\x01", "💩", "<s>", "<0x41>", "</s>"]
SCHEMA = "doc_id long, text string, ids string, n_tokens string"


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def model_file(pieces, kind=spm.UNIGRAM, fallback=True, prefix=1, squeeze=0):
    out = b""
    for piece, score, type_ in pieces:
        text = piece.encode()
        body = b"\x0a" + varint(len(text)) + text + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(type_)
        out += b"\x0a" + varint(len(body)) + body
    trainer = b"\x18" + varint(kind) + b"\x98\x02" + varint(int(fallback))
    rules = b"\x0a\x08identity\x18" + varint(prefix) + b"\x20" + varint(squeeze) + b"\x28\x01"
    return out + b"\x12" + varint(len(trainer)) + trainer + b"\x1a" + varint(len(rules)) + rules


@pytest.fixture(scope="module")
def given():
    with open(public_tokenizers.path(spm.MODEL), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def texts(spark):
    pick = random.Random(3)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    return docs[:80] + ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 12))) for _ in range(2000)] + [" " * k + "x" for k in range(40)]


def test_bpe_parity(given, texts):
    assert spm.disagreements(texts, given) == []


def small_unigram(given):
    pieces = spm.unigram_reading(spm.PieceModel.parse(given)).pieces
    return [(p, s, t) for p, s, t in pieces]


@pytest.mark.parametrize("squeeze", [0, 1])
def test_unigram_parity_and_counts(given, texts, squeeze):
    data = model_file(small_unigram(given), squeeze=squeeze)
    assert spm.disagreements(texts, data) == []
    counter, other = spm.PieceCounter(spm.PieceModel.parse(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [counter.count(t) for t in texts] == [len(x) for x in other.encode(texts)]


def test_unigram_without_byte_pieces():
    pieces = [("<unk>", 0, 2), ("▁", -2, 1), ("a", -2, 1), ("b", -2, 1), ("ab", -3, 1), ("▁a", -4, 1), ("ba", -4, 1), ("aab", -5, 1)]
    data = model_file(pieces, fallback=False)
    texts = ["ab", "aab", "a b", "xyz", "axyb", "x ax", "abab", "baab", "", " ", "aaaa"]
    assert spm.disagreements(texts, data) == []
    counter, other = spm.PieceCounter(spm.PieceModel.parse(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [counter.count(t) for t in texts] == [len(x) for x in other.encode(texts)]


def test_decoding_gives_the_text(given, texts):
    codec, other = spm.PieceCodec(spm.PieceModel.parse(given), 1), sentencepiece.SentencePieceProcessor(model_proto=given)
    ids = codec.encode(texts)
    assert codec.decode(ids) == texts
    pick = random.Random(4)
    odd = [[pick.randrange(32000) for _ in range(6)] for _ in range(300)]
    odd = [[i for i in row if i > 258] for row in odd] + [[1, 15043, 2]]
    assert codec.decode([array("I", row).tobytes() for row in odd]) == [other.decode(row) for row in odd]


def rows():
    return [(1, "hello world", "x", "y"), (2, None, None, None), (3, "", None, None), (None, "no id", None, None), (4, "long text " * 20_000, None, None), (1, "hello world", "x", "y")]


def test_frames(spark, given):
    docs = spark.createDataFrame(rows(), SCHEMA)
    other = sentencepiece.SentencePieceProcessor(model_proto=given)
    for r, (doc, text, *_) in zip(sorted(spm.encoded(docs).collect(), key=str), sorted(rows(), key=lambda r: str(r))):
        assert r.decoded is not None
    by_doc = {r.doc_id: r for r in spm.encoded(docs).collect()}
    for doc, text, *_ in rows():
        assert array("I", bytes(by_doc[doc].ids)).tolist() == other.encode(text or "") and by_doc[doc].decoded == (text or "")
    back = spm.decoded(spm.encoded(docs).drop("decoded"))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(d, t or "") for d, t, *_ in rows()}
    counts = {r.doc_id: (r.n_chars, r.n_tokens) for r in spm.token_counts(docs).collect()}
    assert counts[2] == counts[3] == (0, 0) and counts[4][0] == 200_000
    assert spm.encoded(spark.createDataFrame([], SCHEMA)).count() == spm.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0
