"""Snapshots of conversations collapse to maximal ones, against comparing all prefixes."""

import random

from tableload.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n int, part string"


def log():
    pick = random.Random(9)
    convs = {}
    for c in range(60):
        base = convs[pick.choice(list(convs))] if convs and pick.random() < 0.6 else []
        turns = base[: pick.randint(0, len(base))] + [(pick.choice(["user", "assistant"]), f"t{pick.randint(0, 5)}") for _ in range(pick.randint(0, 3))]
        convs[c] = turns or [("user", "hello")]
    convs[100] = [("user", f"turn {i}") for i in range(1500)]
    convs[101] = convs[100][:700]
    convs[102] = [("user", "long " * 30_000)]
    rows = [(c, i, role, text, 1, "x") for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    rows += [(103, 0, None, None, None, None), (104, 0, None, None, None, None), (None, 0, "user", "lost", None, None), (105, None, "user", "lost", None, None)]
    return convs, rows + rows[:5]


def test_maximal_conversations(spark):
    convs, rows = log()
    convs = {**convs, 103: [("", "")], 104: [("", "")]}
    got = chat.rendered(spark.createDataFrame(rows, SCHEMA)).collect()
    whole = {}
    for c, turns in convs.items():
        whole.setdefault(tuple(turns), []).append(c)
    expected = {}
    for turns, ids in whole.items():
        if not any(len(t) > len(turns) and t[: len(turns)] == turns for t in whole):
            expected[min(ids)] = (turns, len(ids))
    assert {r.conv_id for r in got} == set(expected)
    for c, (turns, n) in expected.items():
        parts = sorted((r for r in got if r.conv_id == c), key=lambda r: r.part)
        assert all((r.n_turns, r.n_copies) == (len(turns), n) for r in parts) and len(parts) == -(-len(turns) // chat.BLOCK)
        assert "".join(r.chat for r in parts) == "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def test_turns_with_one_number_have_a_fixed_order(spark):
    rows = [(1, 0, "user", "a", 0, ""), (1, 0, "user", "b", 0, ""), (2, 0, "user", "b", 0, ""), (2, 0, "user", "a", 0, "")]
    got = chat.rendered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.conv_id, r.n_turns, r.n_copies) for r in got] == [(1, 2, 2)]


def test_no_rows(spark):
    assert chat.rendered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark, plan):
    text = plan(chat.rendered(spark.createDataFrame(log()[1], SCHEMA)))
    assert "Python" not in text and "Arrow" not in text
