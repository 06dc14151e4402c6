"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

Four kinds are taken by their pattern and check alone, whatever stands around them: e-mail addresses, IP addresses, card
numbers of 16 to 19 digits (Luhn) and phone numbers with a leading plus. They are never dropped. Further kinds are
proposed more freely; each has a prior score, which its checksum (mod 97 of an IBAN, Luhn of a shorter card) and the words
around it raise or lower, and a span stays if the score reaches ``THRESHOLD`` and no other span covers a part of it.

Each pattern reads a text in one pass, so that runs of a million digits or letters take no longer than prose. Only texts go
to Python, and only spans come back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tableload.llm.common import array_slices

THRESHOLD = 0.5
AROUND = 48  # characters before a span, and half as many after it, that are read for words

# The kinds, in order; the first four are the base ones.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone", "short_card", "hidden_email", "ipv6")

# A kind's score before its words are read, and the words (their beginnings) that speak for it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.8, "iban": 0.8, "ssn": 0.4, "local_phone": 0.2, "short_card": 0.3, "hidden_email": 0.5, "ipv6": 0.6}
FOR = {
    "email": "mail contact kontakt contacto correo courriel write",
    "ip": "ip host server address adresse dirección serveur",
    "card": "card karte carte tarjeta visa mastercard credit kredit",
    "phone": "phone tel call fax mobil móvil handy cell whatsapp portable ruf",
    "iban": "iban account konto compte cuenta bank transfer überweis virement",
    "ssn": "ssn social security",
    "local_phone": "phone tel téléphone fax mobil móvil handy cell whatsapp portable rufnummer",
    "short_card": "card karte carte tarjeta amex american diners credit kredit",
    "hidden_email": "mail contact kontakt contacto correo courriel write reach",
    "ipv6": "ip host server address adresse dirección serveur",
}
# Words that speak against any kind.
AGAINST = "isbn issn doi version order invoice serial sku part page article isbn-13 rechnung bestell factura facture"
STEP = 0.35  # what words for or against add or take

_DIGITS = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,5}\)|0?[0-9]{1,4})[ ./-][0-9](?:[ ./-]?[0-9]){4,9}(?![0-9])")
_HIDDEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(] ?dot ?[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,8}")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod_97(code: str) -> bool:
    """Whether an account number (letters and digits) leaves 1, its first four characters moved to the end."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @ the run of name characters before it and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, from the left of each run of digits and dots."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, start, parts = run.start(), run.start(), []
        for part in run.group().split("."):
            if not parts:
                start = at
            parts = [*parts, part] if part else []
            at += len(part) + 1
            if len(parts) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                    yield start, at - 1
                parts = []


def cards(text: str, least: int = 16, most: int = 19) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= least:
            digits = m.group().replace(" ", "").replace("-", "")
            if least <= len(digits) <= most and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.findall(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Of a proposed run, the longest beginning that ends with a word and passes the checksum."""
    for m in _IBAN.finditer(text):
        for end in range(m.end(), m.start() + 14, -1):
            if text[end - 1] != " " and not (end < len(text) and text[end].isalnum()):
                code = text[m.start() : end].replace(" ", "")
                if 15 <= len(code) <= 34 and mod_97(code):
                    yield m.start(), end
                    break


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the further kinds that pass their check."""
    if _DIGITS.search(text):
        yield from (("iban", *s) for s in ibans(text))
        for m in _SSN.finditer(text):
            area, group, serial = m.groups()
            if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
                yield "ssn", *m.span()
        yield from (("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text))
        yield from (("short_card", *s) for s in cards(text, 13, 15))
        if ":" in text:
            yield from (("ipv6", *m.span()) for m in _IPV6.finditer(text))
    if "at" in text and ("(" in text or "[" in text):
        yield from (("hidden_email", *m.span()) for m in _HIDDEN.finditer(text))


def _score(text: str, kind: str, start: int, end: int) -> float:
    """The prior, raised by a word for the kind nearby, lowered by one against it."""
    nearby = text[max(0, start - AROUND) : start].lower() + " " + text[end : end + AROUND // 2].lower()
    words = _WORD.findall(nearby)
    score = PRIOR[kind]
    score += STEP * any(w.startswith(tuple(FOR[kind].split())) for w in words)
    score -= STEP * any(w.startswith(tuple(AGAINST.split())) for w in words)
    return round(min(1.0, max(0.0, score)), 4)


def spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by kind in the order of ``KINDS``, then start; positions in code points, the end excluded."""
    if not text:
        return []
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [("ip", *s) for s in addresses(text)]
        found += [("card", *s) for s in cards(text)]
        found += [("phone", *s) for s in phones(text)] if "+" in text else []
    out = [Span(*s, _score(text, *s)) for s in found]
    more = [Span(*s, _score(text, *s)) for s in _proposed(text)]
    for span in sorted(more, key=lambda s: (-s.score, s.start, KINDS.index(s.kind))):
        if span.score >= threshold and all(span.end <= o.start or o.end <= span.start for o in out):
            out.append(span)
    return sorted(out, key=lambda s: (KINDS.index(s.kind), s.start))


SPANS_TYPE = "array<struct<kind: string, start: int, end: int, score: double>>"
_ARROW_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([[s._asdict() for s in spans(t)] for part in array_slices(batch) for t in part.to_pylist()], _ARROW_TYPE)


def _mask(texts: pa.Array) -> pa.Array:
    return pa.array([masked(t) for part in array_slices(texts) for t in part.to_pylist()], pa.string())


def masked(text: str | None) -> str | None:
    """The text with its spans replaced by their kinds in angle brackets."""
    out, done = [], 0
    for s in sorted(spans(text), key=lambda s: (s.start, s.end)):
        if s.start >= done:
            out += [text[done : s.start], f"<{s.kind}>"]
        done = max(done, s.end)
    return text if not out else "".join([*out, text[done:]])


def found(text: Column) -> Column:
    """The spans of a text column; null and empty texts have none."""
    return F.arrow_udf(_find, SPANS_TYPE)(text)


def with_masked_text(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with personal data masked in ``text_col``, all other columns as they are."""
    return docs.withColumn(text_col, F.arrow_udf(_mask, "string")(F.col(f"`{text_col}`").cast("string")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the number of each base kind, base_sha256 and spans.

    ``spans`` lists kind:start:end of every span, by kind in the order of ``KINDS``, then start; base_sha256 is the
    SHA-256 of the base ones so listed. Null and empty texts have none; repeated rows count each; extra columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col).cast("string")).alias("found"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def listed(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
