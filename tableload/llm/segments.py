"""Exact token ids of whole texts, from the ids of segments that no token can cross.

The byte-level splitting rule never joins a Latin word with what follows it, nor with anything before it but one
space. Texts of such words, figures and punctuation are therefore cut around words; a text with an apostrophe before a
word, several white-space characters before a word, or other scripts is cut only before single spaces between other
characters, where the rule cuts too. Each worker encodes a distinct segment once while it remembers it, and joins
the ids of its texts from there.

Texts whose spaces all stand single between other characters, which are nearly all, are cut at these spaces by Arrow; the
few others take the rules above.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

KNOWN_SEGMENTS = 600_000
CAREFUL_SEGMENTS = 100_000
KNOWN_WORDS = 400_000
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_WORDS = re.compile(f" ?[{_LATIN}]+(?:'[{_LATIN}]+)*|(?:(?! ?[{_LATIN}])[\\s\\S])+")
_END_MARKS = (".", ",", ";", ":", "!", "?")  # one of these after a word is a segment of its own
_SPACED_WORD = re.compile(rf"\s\s[{_LATIN}]")
_QUOTED_WORD = re.compile(f"(?<![{_LATIN}])'[{_LATIN}]")
_OTHER_SCRIPT = re.compile("[ɐ-‏ -  -\U0010ffff]")
_BORDER = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(name: str) -> str:
    """A path as it is, or the place of a named public vocabulary on this machine."""
    return name if os.path.isabs(name) else public_tokenizers.path(name)


def segments(text: str) -> list[str]:
    odd = _SPACED_WORD.search(text) or "'" in text and _QUOTED_WORD.search(text)
    if odd or not text.isascii() and _OTHER_SCRIPT.search(text):
        first, *rest = _BORDER.split(text)
        return [first, *[" " + part for part in rest]]
    return _WORDS.findall(text)


def looked_up(cut: list[list[str]], known: dict[str, bytes], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """The bytes of each list of segments, joined; ``make`` gives those that are not known yet.

    Arrow numbers the segments, so that Python sees each distinct one once, and puts their bytes side by side.
    """
    segments = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
    distinct = segments.dictionary.to_pylist()
    new = [s for s in distinct if s not in known]
    known.update(zip(new, make(new)))
    if not distinct:
        return [b""] * len(cut)
    joined = pa.array([known[s] for s in distinct], pa.binary()).take(segments.indices)
    _, offsets, data = joined.buffers()
    ends = np.frombuffer(offsets, np.int32)[joined.offset + np.cumsum([0, *map(len, cut)])]
    view = memoryview(data)
    return [bytes(view[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def joined_bytes(values: pa.Array, indices: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Of each stretch of ``indices`` (they end at ``ends``) the values it points at, side by side."""
    joined = values.take(pa.array(indices))
    _, offsets, data = joined.buffers()
    at = np.frombuffer(offsets, np.int32)[joined.offset + np.concatenate([[0], ends])].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [bytes(view[a:b]) for a, b in zip(at, at[1:])]


class Remembered:
    """The bytes of texts met so far, in Arrow arrays: a tenth of what Python objects would take."""

    def __init__(self, most: int):
        self.most = most
        self.keys, self.values = pa.array([], pa.string()), pa.array([], pa.binary())

    def get(self, asked: pa.Array, make: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The bytes of each of ``asked``, which are distinct; ``make`` gives those of texts that are not known."""
        at = pc.index_in(asked, value_set=self.keys)
        fresh = asked.filter(at.is_null())
        if not len(fresh):
            return self.values.take(at)
        made = make(fresh)
        place = at.fill_null(0).to_numpy().copy()
        place[at.is_null().to_numpy(zero_copy_only=False)] = len(self.keys) + np.arange(len(fresh))
        values = pa.concat_arrays([self.values, made])
        out = values.take(pa.array(place))
        if len(values) > self.most:  # only what was just asked for is kept
            self.keys, self.values = asked, out
        else:
            self.keys, self.values = pa.concat_arrays([self.keys, fresh]), values
        return out


class SegmentEncoder:
    """Little-endian unsigned 32-bit ids of texts under a byte-level vocabulary of the tokenizers library."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # segments of texts that are cut with care
        self.spaced = Remembered(KNOWN_WORDS)  # what stands between two spaces: its ids with the space before it
        self.plain = Remembered(KNOWN_WORDS)  # of these, words of letters alone
        self.ends = pa.array(self._bytes(list(_END_MARKS)), pa.binary())

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _joined(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CAREFUL_SEGMENTS:
            self.known.clear()
        return looked_up([segments(t) for t in texts], self.known, self._bytes)

    def _spaced_words(self, words: pa.Array) -> pa.Array:
        """Words of letters with one mark at most are put together from both; the others are cut with care."""
        core = pc.utf8_rtrim(words, "".join(_END_MARKS))
        marks = pc.subtract(pc.binary_length(words), pc.binary_length(core))
        simple = pc.and_(pc.match_substring_regex(core, f"^[{_LATIN}]+$"), pc.less_equal(marks, 1))
        letters = core.filter(simple).dictionary_encode()
        own = self.plain.get(letters.dictionary, lambda new: pa.array(self._bytes([" " + w for w in new.to_pylist()]), pa.binary()))
        last = pc.utf8_slice_codeunits(words.filter(simple), -1, 2**31 - 1)
        ended = pc.equal(marks.filter(simple), 1)
        end = self.ends.take(pc.index_in(last, value_set=pa.array(list(_END_MARKS))))
        end = pc.if_else(ended, end, pa.scalar(b"", pa.binary()))
        whole = pc.binary_join_element_wise(own.take(letters.indices), end, pa.scalar(b"", pa.binary()))
        others = self._joined([" " + w for w in words.filter(pc.invert(simple)).to_pylist()])
        simple = simple.to_numpy(zero_copy_only=False)
        place = np.where(simple, np.cumsum(simple) - 1, len(whole) + np.cumsum(~simple) - 1)
        return pa.concat_arrays([whole, pa.array(others, pa.binary())]).take(pa.array(place))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        if not len(column):
            return []
        parts = pc.split_pattern(column, " ")
        starts = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        flat = parts.flatten().dictionary_encode()
        words, indices = flat.dictionary, flat.indices.to_numpy()
        # a space that is not alone between other characters is no border
        begins, ends = np.zeros(len(words), bool), np.zeros(len(words), bool)
        spaced = pc.or_(pc.not_equal(pc.utf8_trim_whitespace(words), words), pc.equal(pc.binary_length(words), 0))
        for i in np.flatnonzero(spaced.to_numpy(zero_copy_only=False)):
            word = words[int(i)].as_py()
            begins[i], ends[i] = not word or word[0].isspace(), not word or word[-1].isspace()
        begins, ends = begins[indices], ends[indices]
        begins[starts] = False
        ends[np.concatenate([starts[1:], [len(indices)]]) - 1] = False
        odd = np.logical_or.reduceat(begins | ends, starts)
        for mark in self.marks:  # these may stand across borders
            odd |= pc.match_substring(column, mark).to_numpy(zero_copy_only=False)
        firsts = words.take(pa.array(indices[starts])).to_pylist()  # no space stands before a text's first word
        values = pa.concat_arrays([self.spaced.get(words, self._spaced_words), pa.array(self._bytes(firsts), pa.binary())])
        placed = indices.copy()
        placed[starts] = len(words) + np.arange(len(firsts))
        out = joined_bytes(values, placed, np.concatenate([starts[1:], [len(indices)]]))
        for i in np.flatnonzero(odd):
            text = column[int(i)].as_py()
            out[i] = (self._bytes if any(m in text for m in self.marks) else self._joined)([text])[0]
        return out


_encoders: dict[str, SegmentEncoder] = {}


def encoder(vocabulary: str) -> SegmentEncoder:
    """This worker's encoder: tasks that follow one another keep its segments."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = SegmentEncoder(vocabulary)
    return _encoders[vocabulary]
