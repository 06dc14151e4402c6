"""Cheapest edits against all edits of short conversations; grammars, blocks and digests against plain loops."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tableload.llm import repair

ROLE = {"s": "s", "u": "u", "a": "a"}


def every_edit(symbols):
    """The cheapest (cost, letters) among all edits with at most two insertions in a row."""
    best = None
    slots = [("", "I", "II")] * (len(symbols) + 1)
    for inserts in itertools.product(*slots):
        for letters in itertools.product("DKR", repeat=len(symbols)):
            cost, out, ok = 0, [], True
            for before, letter, symbol in zip(inserts, letters, symbols):
                out += [None] * len(before)
                cost += 2 * len(before)
                if letter == "D":
                    cost += 3
                    continue
                if symbol in "bd":
                    ok = False
                    break
                cost += symbol.isupper() + 2 * (letter == "R")
                out.append(symbol.lower() if letter == "K" else None)
            if not ok:
                continue
            out += [None] * len(inserts[-1])
            cost += 2 * len(inserts[-1])
            rest = out[1:] if out and out[0] == "s" else out
            if any(r is not None and r != "ua"[i % 2] for i, r in enumerate(rest)) or len(rest) % 2 or (out and not rest):
                continue
            found = cost, "".join(i + e for i, e in zip(inserts, letters)) + inserts[-1]
            best = min(best or found, found)
    return best


def test_edits_are_the_cheapest_and_first_in_ascii():
    grammar, pick = repair.Grammar([]), random.Random(1)
    cases = ["".join(p) for n in range(1, 3) for p in itertools.product(repair.LEAVES, repeat=n)]
    cases += ["".join(pick.choice(repair.LEAVES) for _ in range(n)) for n in (3, 4) for _ in range(60 if n == 3 else 25)]
    for symbols in cases:
        assert grammar.solve([symbols]) == every_edit(symbols), symbols


def stepwise(symbols):
    """All four states with their whole strings, turn by turn."""
    states = {0: (0, "")}
    for symbol in symbols:
        new = {}
        for state, (cost, letters) in states.items():
            at = state
            for n in range(3):
                for more, letter, end in repair.edits(symbol, at):
                    found = cost + 2 * n + more, letters + "I" * n + letter
                    new[end] = min(new.get(end, found), found)
                at = repair.NEXT[at]
        states = new
    return min((c + 2 * repair.CLOSE[s], a + "I" * repair.CLOSE[s]) for s, (c, a) in states.items())


def test_grammar_and_blocks_change_nothing():
    pick = random.Random(2)
    rules, known = [], list(repair.LEAVES)
    for i in range(60):
        rules.append((chr(repair.FIRST_SYMBOL + i), pick.choice(known), pick.choice(known)))
        known.append(rules[-1][0])
    grammar, plain = repair.Grammar(rules), repair.Grammar([])
    for _ in range(400):
        symbols = "".join(pick.choice(pick.choice(["ua", "uab", repair.LEAVES])) for _ in range(pick.randint(1, 60)))
        cuts = sorted({0, len(symbols), *(pick.randint(0, len(symbols)) for _ in range(pick.randint(0, 4)))})
        blocks = [symbols[a:b] for a, b in zip(cuts, cuts[1:])]
        assert grammar.solve(blocks) == plain.solve([symbols]) == stepwise(symbols)


SCHEMA = "conv_id long, turn long, role string, text string, symbol string"
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """conv_id -> what ``repaired`` returns, by loops over rows (conv_id, turn, role, text, present)."""
    convs = {}
    for conv, turn, role, text, present in rows:
        own = convs.setdefault(conv, [])
        if present:
            role, text = " " if role is None else role, " " if text is None else text
            own.append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), turn, role, text))
    out = {}
    for conv, own in convs.items():
        own = [r[3:] for r in sorted(own)]
        seen, symbols, counts = set(), "", [0, 0, 0]
        for _, role, text in own:
            said = SPACE.findall(text)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not said:
                symbols, counts[0] = symbols + "b", counts[0] + 1
            elif (role, text) in seen:
                symbols, counts[1] = symbols + "d", counts[1] + 1
            elif said[-1] not in ".!?":
                symbols, counts[2] = symbols + letter.upper(), counts[2] + 1
            else:
                symbols += letter
            seen.add((role, text))
        cost, audit = stepwise(symbols)
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        lines, rest = [], iter(own)
        for letter in audit:
            _, role, text = next(rest) if letter != "I" else (None, "", "")
            if letter != "D":
                first = 1 if lines and lines[0].startswith("s") else 0
                new = ("user", "assistant")[(len(lines) - first) % 2]
                lines.append(f"{role if letter == 'K' else new}:{text}")
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    pick = random.Random(4)
    texts = ["Yes.", "No!", "why", "", " \n", "Go on?", "cut off,", "é.", "A longer answer. With more"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    out = [(c, t, pick.choice(roles), pick.choice(texts + [None, f"text {t}."])) for c in range(150) for t in range(pick.choice([1, 2, 5, 9]))]
    out += [(500, t, "user" if t % 2 else "assistant", f"turn {t}" + pick.choice([".", ""])) for t in range(1, 2600)]
    out += [(501, pick.choice([None, 1, 7]), pick.choice(roles), pick.choice(texts)) for _ in range(40)]
    out += [(None, t, "user", "Hm.") for t in range(4)] + [out[3], out[3]]
    out += [(502, t, "user", "word " * 40_000 + ".") for t in range(3)]
    return out


def test_digests_against_loops(spark):
    data = [(*r, "x") for r in conversations()]
    frame = spark.createDataFrame(data, SCHEMA).repartition(7)
    got = repair.repaired(repair.turns_of(frame)).collect()
    expected = brute([(*r[:4], True) for r in data])
    assert len(got) == len(expected)
    for r in got:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == expected[r.conv_id], r.conv_id


def test_damage_and_lost_conversations(spark):
    data = conversations() + [(c, 0, "user", "alone.") for c in range(1000, 1080)]
    after = []
    for conv, turn, role, text in data:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        after += [(conv, turn, "user" if hit == 4 else role, text, hit != 0)] * (2 if hit == 3 else 1)
    expected = brute(after)
    frame = spark.createDataFrame([(*r, "x") for r in data], SCHEMA)
    got = {r.conv_id: tuple(r[1:]) for r in repair.repaired(repair.damaged(frame)).collect()}
    assert got == expected
    nothing = hashlib.sha256(b"").hexdigest()
    assert any(v == (0, 0, 0, 0, 0, 0, "", nothing) for v in got.values())


def test_repaired_turns_read_as_they_should(spark):
    frame = spark.createDataFrame([(*r, "x") for r in conversations()], SCHEMA)
    turns = repair.repaired_turns(repair.turns_of(frame)).toPandas().sort_values(["conv_id", "position"])
    for _, own in turns.groupby("conv_id", dropna=False):
        assert re.fullmatch("s?(ua)+", "".join(r[0] for r in own.role))
        assert (own.text[own.edit == "I"] == "").all() and list(own.position) == list(range(len(own)))


@pytest.mark.parametrize("most", [0, 512])
def test_rules_do_not_change_the_plan(spark, most):
    frame = spark.createDataFrame([(*r, "x") for r in conversations()], SCHEMA)
    blocks = repair.symbols_of(repair.turns_of(frame))
    rules = repair.re_pair(blocks, most)
    assert len(rules) == len({r[0] for r in rules}) and (len(rules) > 20) == (most > 0)
    got = {r.conv_id: (r.cost, r.audit) for r in repair.solved(blocks, rules).collect()}
    expected = {c: v[5:7] for c, v in brute([(*r, True) for r in conversations()]).items()}
    assert got == expected


def test_no_rows(spark):
    assert repair.repaired(repair.turns_of(spark.createDataFrame([], SCHEMA))).count() == 0
