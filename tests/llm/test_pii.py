"""Base spans against the plain patterns; checksums, words nearby, and texts that would take a pattern long."""

import hashlib
import random
import re
import time

import pytest

from tableload.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if checked(k, m.group())]


def valid_card(pick, n):
    body = "".join(pick.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def texts():
    pick = random.Random(8)
    parts = ["a", "é", "@", ".", ".", "-", "_", "%", "+", "+", "1", "0", "25", "255", "256", "007", " ", "(", ")", "中", "b@c.d", "1.2.3.4", "\n", ","]
    out = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 30))) for _ in range(6000)]
    for _ in range(300):
        number = valid_card(pick, pick.randint(14, 20))
        out.append("x " + "".join(d + pick.choice(["", "", " ", "-"]) for d in number) + pick.choice([" y", "-", "5"]))
    return out


def test_base_spans_are_those_of_the_plain_patterns():
    for text in texts():
        got = [(s.kind, s.start, s.end) for s in pii.spans(text) if s.kind in pii.BASE]
        assert got == base(text), text


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC", ["iban"]),
        ("konto GB82WEST12345698765432.", ["iban"]),
        ("GB82 WEST 1234 5698 7654 33", []),  # fails mod 97
        ("her SSN is 123-45-6789", ["ssn"]),
        ("range 123-45-6789", []),
        ("ssn 000-45-6789", []),
        ("Tel. 030 1234567", ["local_phone"]),
        ("in 1999 1234567 units", []),
        ("amex card 378282246310005", ["short_card"]),
        ("378282246310005", []),
        ("ISBN card 378282246310005", []),
        ("jo [at] mail (dot) org", ["hidden_email"]),
        ("look (at) this", []),
        ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334", ["ipv6"]),
        ("call +1 (017) 555-7713 now", ["phone"]),
        ("plain words, 12 of them, and 3.5 more", []),
    ],
)
def test_checks_and_words_decide(text, kinds):
    assert [s.kind for s in pii.spans(text)] == kinds


def test_words_move_the_score():
    plain, told, against = (pii.spans(t)[0].score for t in ("10.0.0.1", "server 10.0.0.1", "version 10.0.0.1"))
    assert against < plain < told


def test_long_runs_take_no_longer_than_prose():
    started = time.monotonic()
    for text in ("1" * 300_000, "a" * 300_000, "a." * 150_000 + "@", "1." * 150_000, "+" * 300_000, "+1" + "-" * 300_000, "A1" * 150_000, "1 " * 150_000, "0:" * 150_000, "(at" * 100_000):
        pii.spans(text)
    assert time.monotonic() - started < 20


SCHEMA = "doc_id long, text string, spans string, found string"


def test_query_columns(spark):
    data = [(i, t, "x", "y") for i, t in enumerate(texts()[:1500])] + [(5000, None, None, None), (5001, "", None, None), (None, "a@b.c", None, None), (7, "a@b.c", "x", "y"), (7, "a@b.c", "x", "y")]
    got = [tuple(r) for r in pii.personal_data(spark.createDataFrame(data, SCHEMA)).collect()]
    expected = []
    for doc, text, *_ in data:
        own = base(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        every = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in pii.spans(text))
        counts = [sum(k == kind for k, *_ in own) for kind in pii.BASE]
        expected.append((doc, *counts, hashlib.sha256(listed.encode()).hexdigest(), every))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert pii.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_masked_texts(spark):
    docs = spark.createDataFrame([(1, "write a@b.cd or +1 (017) 555-7713.", "k", "m"), (2, None, "k", "m"), (3, "clean", "k", "m")], SCHEMA)
    out = pii.with_masked_text(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["write <email> or <phone>.", None, "clean"]
