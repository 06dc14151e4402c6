"""SentencePiece models read from their protobuf, rebuilt on the tokenizers library, and counted without encoding.

The model file is parsed directly (piece, score, type; trainer and normaliser settings). Unigram models become a
Unigram model with the file's scores; models of the BPE type, whose scores are merge priorities, become a BPE model
with merges in the order of the scores. The normaliser is rebuilt from the file: its compiled character map, extra
spaces, the marker for spaces and the one put before the text. What no piece covers falls back to bytes if the
file has byte pieces, else to the unknown piece.

Texts are cut where no piece of the vocabulary can span, so that a worker treats each distinct segment once while it
remembers it; the ids of a text are those of its segments in order.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from tableload.llm.common import text_slices
from tableload.llm.segments import KNOWN_SEGMENTS, looked_up, vocabulary_path

MODEL = "piece_bpe_32k.model"
THREADS = 2
MARK = "▁"
UNKNOWN_PENALTY = 10.0
LOWEST_SCORE = -40_000.0
# Numbers of the model file's fields and types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls([])
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif field == 3:
                rules = dict(_fields(value))
                model.char_map = rules.get(2, b"")
                model.dummy_prefix = bool(rules.get(3, 1))
                model.squeeze_spaces = bool(rules.get(4, 1))
                model.escape_spaces = bool(rules.get(5, 1))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return model

    @classmethod
    def load(cls, name: str) -> PieceModel:
        with open(vocabulary_path(name), "rb") as file:
            return cls.parse(file.read())

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN)

    def spelled(self) -> dict[str, tuple[int, float]]:
        """Pieces that text can match, with id and score."""
        return {p: (i, s) for i, (p, s, t) in enumerate(self.pieces) if t in (NORMAL, USER_DEFINED, UNUSED)}


class Normaliser:
    def __init__(self, model: PieceModel):
        self.model = model
        steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
        if model.squeeze_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex(r"\A | \z"), "")]
        self.rules = normalizers.Sequence(steps) if steps else None

    def __call__(self, text: str) -> str:
        if self.rules is not None:
            text = self.rules.normalize_str(text)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape_spaces else text


def cutter(model: PieceModel) -> re.Pattern[str]:
    """Finds the segments of a normalised text: no piece spans two of them."""
    pieces = list(model.spelled())
    if any(MARK in p.lstrip(MARK) for p in pieces) or not model.escape_spaces:
        return re.compile(r"[\s\S]+")
    crossing = re.compile(f"[{_LATIN}][^{_LATIN}]|[^{_LATIN}{MARK}][{_LATIN}]")
    if any(crossing.search(p) for p in pieces):
        return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
    return re.compile(f"{MARK}*(?:[{_LATIN}]+|[^{_LATIN}{MARK}]+)|{MARK}+")


def backend(model: PieceModel) -> Tokenizer:
    """The model in the tokenizers library, without its normaliser; unigram texts keep unknown pieces whole."""
    spelled = model.spelled()
    if model.kind == UNIGRAM:
        # pieces that text must not match get names with a space, which no normalised text has
        vocabulary = [(p if p in spelled and spelled[p][0] == i else f" {i}", s) for i, (p, s, _) in enumerate(model.pieces)]
        tokenizer = Tokenizer(models.Unigram(vocabulary, model.unknown, False))
    else:
        ordered = sorted((-score, i, piece) for piece, (i, score) in spelled.items())
        merges = [(p[:k], p[k:]) for _, _, p in ordered for k in range(1, len(p)) if p[:k] in spelled and p[k:] in spelled]
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        unknown = model.pieces[model.unknown][0]
        tokenizer = Tokenizer(models.BPE(vocabulary, merges, unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback))
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


class PieceCodec:
    """Encodes and decodes batches of texts; ids are little-endian unsigned 32 bits each."""

    def __init__(self, model: PieceModel, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model, self.normalise, self.cut = model, Normaliser(model), cutter(model)
        self.tokenizer = backend(model)
        self.known: dict[str, bytes] = {}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(model.pieces) if t == BYTE}
        # decoding needs the true names: controls vanish, all else is spelled
        self.spoken = Tokenizer(models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, []))
        self.spoken.decoder = self.tokenizer.decoder
        self.silent = {i for i, (_, _, t) in enumerate(model.pieces) if t == CONTROL}

    def _fallback(self, segment: str) -> list[int]:
        """The ids of a segment with unknown characters, these as bytes."""
        found, out = self.tokenizer.encode(segment, add_special_tokens=False), []
        for i, (start, end) in zip(found.ids, found.offsets):
            out.extend([self.bytes[b] for b in segment[start:end].encode()] if i == self.model.unknown else [i])
        return out

    def _bytes_of(self, segments: list[str]) -> list[bytes]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        if self.model.kind == UNIGRAM and self.bytes:
            found = [self._fallback(s) if self.model.unknown in ids else ids for s, ids in zip(segments, found)]
        return [array("I", ids).tobytes() for ids in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut.findall(self.normalise(t)) for t in texts]
        if len(self.known) > KNOWN_SEGMENTS:
            self.known.clear()
        return looked_up(cut, self.known, self._bytes_of)

    def decode(self, batch: list[bytes]) -> list[str]:
        ids = [array("I", b).tolist() for b in batch]
        if self.silent:
            ids = [[i for i in row if i not in self.silent] if self.silent.intersection(row) else row for row in ids]
        return self.spoken.decode_batch(ids, skip_special_tokens=False)


class PieceCounter:
    """Counts unigram pieces without making them.

    An Aho-Corasick automaton gives all pieces that end at a character; dynamic programming carries the best score and
    its number of pieces. Ties go to the earliest start, that is the longest last piece, as the tokenizer decides them.
    Sums are in double precision and exact for the file's single-precision scores, so that counts of segments add up.
    """

    def __init__(self, model: PieceModel):
        self.model, self.normalise, self.cut = model, Normaliser(model), cutter(model)
        self.automaton = ahocorasick.Automaton()
        spelled = model.spelled()
        for piece, (_, score) in spelled.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.lowest = min((s for _, s in spelled.values()), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def segment(self, text: str) -> int:
        n = len(text)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (size, score) in self.automaton.iter(text):
            found[end].append((size, score))
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            matches = sorted(found[end - 1], reverse=True)  # longest first: a tie stays with the earliest start
            top = None
            for size, score in matches:
                total = best[end - size] + score
                if top is None or total > top:
                    top, count[end], unknown[end] = total, count[end - size] + 1, False
            if not matches or matches[-1][0] != 1:
                total = best[end - 1] + self.lowest
                if top is None or total > top:
                    more = len(text[end - 1].encode()) if self.model.byte_fallback else int(not unknown[end - 1])
                    top, count[end], unknown[end] = total, count[end - 1] + more, True
            best[end] = top
        return count[n]

    def count(self, text: str) -> int:
        parts = self.cut.findall(self.normalise(text))
        known = self.known
        if len(known) > KNOWN_SEGMENTS:
            known.clear()
        for part in set(parts).difference(known):
            known[part] = self.segment(part)
        return sum(map(known.__getitem__, parts))


_workers: dict[tuple, object] = {}


def _kept(key: tuple, make):
    """This worker's codec or counter: tasks that follow one another keep its segments."""
    if key not in _workers:
        _workers[key] = make()
    return _workers[key]


def unigram_reading(model: PieceModel) -> PieceModel:
    """The same pieces and scores read as a unigram model; scores that stand for "last of all" become ``LOWEST_SCORE``."""
    pieces = [(p, max(s, LOWEST_SCORE), t) for p, s, t in model.pieces]
    return PieceModel(**{**model.__dict__, "pieces": pieces, "kind": UNIGRAM})


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, threads: int = THREADS, carry_text: bool = False
) -> DataFrame:
    """(doc_id, ids binary, decoded) per row of ``docs``: ids of the whole text, and the text they decode to.

    Null and empty texts have no ids and decode to the empty text. Extra columns are ignored. ``carry_text`` adds the
    text as it came.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _kept(("codec", model, threads), lambda: PieceCodec(PieceModel.load(model), threads))
        for batch in text_slices(batches, 4 << 20):
            ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary()), "decoded": pa.array(codec.decode(ids), pa.string())}
            if carry_text:
                columns["text"] = batch.column("text")
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string" + ", text string" * carry_text)


def decoded(rows: DataFrame, ids_col: str = "ids", model: str = MODEL, threads: int = THREADS, name: str = "text") -> DataFrame:
    """``rows`` with the text of their ids (binary) in place of them; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _kept(("codec", model, threads), lambda: PieceCodec(PieceModel.load(model), threads))
        for batch in text_slices(batches, 4 << 20):
            ids = batch.column(ids_col).to_pylist()
            texts = [t if b is not None else None for b, t in zip(ids, codec.decode([b or b"" for b in ids]))]
            kept = [c for c in batch.schema.names if c != ids_col]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, name])

    kept = [f for f in rows.schema.fields if f.name != ids_col]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{name}` string"])
    return rows.mapInArrow(run, schema)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, n_chars, n_tokens) per row of ``docs``: pieces of the whole text under the unigram reading of the model.

    Null and empty texts have none. Extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _kept(("counter", model), lambda: PieceCounter(unigram_reading(PieceModel.load(model))))
        for batch in text_slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), pa.array(list(map(counter.count, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_tokens long")


def disagreements(texts: list[str], model: bytes) -> list[str]:
    """Texts whose ids differ from those of the sentencepiece library under the same model file."""
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = PieceCodec(PieceModel.parse(model), threads=1)
    return [t for t, ids, found in zip(texts, other.encode(texts), codec.encode(texts)) if array("I", found).tolist() != ids]
