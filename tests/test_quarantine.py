"""Messages that cannot be loaded are kept, with the reason, each once; loads of streams are measured."""

import pytest

from tableload import ColSchema
from tableload.operators.messages import quarantined
from tableload.plans.table import Table
from tableload.streaming.append import load_messages

COLS = [ColSchema("id", "int32", required=True), ColSchema("n", "float64"), ColSchema("note", "string")]
MESSAGES = [
    (0, '{"id": 1, "n": 2.5, "note": "x"}'), (1, '{"id": "7"}'), (2, '{"id": null}'), (3, '{"id": "q", "n": "z"}'), (4, "[1]"),
    (5, '{"id": 1'), (6, None), (7, ""), (8, '{"id": 3000000000}'), (9, '{"id": 5, "n": null, "other": 1}'), (9, '{"id": 5, "n": null, "other": 1}'),
]
REASONS = [None, None, "id: missing", "id: no int32, n: no float64", *["no JSON object"] * 4, "id: no int32", None, None]


def frame(spark):
    return spark.createDataFrame(MESSAGES, "_offset long, value string")


def test_reasons(spark):
    rows = quarantined(frame(spark), COLS).orderBy("_offset").collect()
    assert [r["_reason"] for r in rows] == REASONS
    assert [r["_rejected"] for r in rows] == [m if why else None for (_, m), why in zip(MESSAGES, REASONS)]


def test_each_message_is_in_one_table_once(spark, warehouse):
    good, bad = warehouse.table("t", "good"), warehouse.table("t", "bad")

    class Dying(Table):
        def load(self, *args, **options):
            raise RuntimeError

    with pytest.raises(RuntimeError):
        load_messages(frame(spark), good, Dying(spark, warehouse.root, "t", "bad"), COLS, "b0")
    for _ in range(2):
        assert load_messages(frame(spark), good, bad, COLS, "b0") == (4, 7)
    assert sorted(r.id for r in good.read().collect()) == [1, 5, 5, 7]
    assert sorted((r._offset, r.message, r.reason) for r in bad.read().collect() if r.message) == sorted(
        (o, m, why) for (o, m), why in zip(MESSAGES, REASONS) if why and m
    )


def test_an_empty_batch(spark, warehouse):
    assert load_messages(frame(spark).limit(0), warehouse.table("t", "g"), warehouse.table("t", "b"), COLS, "b0") == (0, 0)


def test_measured_loads(spark, warehouse):
    table = warehouse.table("t", "m")
    table.load(spark.createDataFrame([(1, "ab"), (2, None)], "id int, note string"), load_id="a", measure=True)
    table.load(spark.createDataFrame([(3, "c")], "id int, note string"), load_id="b")
    table.load(spark.createDataFrame([], "id int, note string"), load_id="c", measure=True)
    got = [(r.load_id, r.rows, r.bytes) for r in table.metrics().orderBy("seq").collect()]
    assert got == [("a", 2, 10), ("c", 0, 0)]
