"""Clean-up in event order, loads in parts that the feed itself completes, and transforms on the way in."""

import pytest
from pyspark.sql import functions as F

from tableload import ColSchema, Warehouse
from tableload.operators.feed import control_events, table_to_changes
from tableload.operators.transform import Transform

COLS = [ColSchema("id", "int64"), ColSchema("note", "string")]
SCHEMAS = {("ns", "t"): COLS, ("ns", "u"): COLS}


def rows(spark, *ids, lsn=None, table="t", part=None):
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, note string")
    return table_to_changes(df, "ns", table, lsn=None if lsn is None else F.lit(lsn), load_part=None if part is None else F.lit(part))


def event(spark, kind, lsn=None, table="t", part=None, parts=None):
    place = {"lsn": None if lsn is None else F.lit(lsn), "load_part": None if part is None else F.lit(part)}
    return control_events(spark.range(1), F.lit(kind), F.lit("ns"), F.lit(table), parts=None if parts is None else F.array(*[F.lit(p) for p in parts]), **place)


def stack(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def ids(table):
    return sorted(r["id"] for r in table.read().collect())


@pytest.mark.parametrize("stage", [True, False])
def test_only_rows_after_the_last_clean_up_stay(spark, warehouse, stage):
    table = warehouse.table("ns", "t")
    table.load(spark.createDataFrame([(0, "before")], "id long, note string"), COLS)
    feed = stack(rows(spark, 1, lsn=1), event(spark, "truncate", 2), rows(spark, 2, lsn=3), rows(spark, 7, lsn=1, table="u"))
    for _ in range(2):
        warehouse.load_feed(feed, SCHEMAS, "x", stage=stage)
    assert ids(table) == [2] and ids(warehouse.table("ns", "u")) == [7]


def test_several_events_and_rows_without_a_position(spark, warehouse):
    feed = stack(
        rows(spark, 1, lsn=1), event(spark, "truncate", 2), rows(spark, 2, lsn=3), event(spark, "drop", 4), rows(spark, 4, lsn=4),
        rows(spark, 5, lsn=5), event(spark, "truncate"), rows(spark, 6),
    )
    warehouse.load_feed(feed, SCHEMAS, "x")
    assert ids(warehouse.table("ns", "t")) == [5, 6]


def test_events_without_a_position_act_first(spark, warehouse):
    warehouse.table("ns", "t").load(spark.createDataFrame([(0, "before")], "id long, note string"), COLS)
    warehouse.load_feed(stack(rows(spark, 1, lsn=1), rows(spark, 2), event(spark, "truncate")), SCHEMAS, "x")
    assert ids(warehouse.table("ns", "t")) == [1, 2]


def test_a_feed_that_ends_with_its_clean_up_leaves_no_rows(spark, warehouse):
    warehouse.load_feed(rows(spark, 1), SCHEMAS, "first")
    warehouse.load_feed(stack(rows(spark, 2, lsn=1), event(spark, "drop", 9)), SCHEMAS, "x")
    assert not warehouse.table_exists("ns", "t")


def test_a_missing_done_event_keeps_all_hidden(spark, warehouse):
    table = warehouse.table("ns", "t")
    warehouse.stage_feed(stack(rows(spark, 1, part="a"), event(spark, "done_table", part="a")), SCHEMAS, "l")
    warehouse.stage_feed(rows(spark, 2, part="b"), SCHEMAS, "l")
    assert not warehouse.stage_feed(event(spark, "done_sharded", parts=["a", "b", "c"]), SCHEMAS, "l") and ids(table) == []
    assert not warehouse.stage_feed(event(spark, "done_table", part="c"), SCHEMAS, "l") and ids(table) == []
    state = warehouse.progress("l").first()
    assert (state.staged, state.ended, state.announced, state.closed, state.complete) == (["a", "b"], ["a", "c"], ["a", "b", "c"], True, False)
    # the worker of part b runs again, from another driver
    other = Warehouse(spark, warehouse.root)
    done = other.stage_feed(stack(rows(spark, 3, 4, part="b"), event(spark, "done_table", part="b")), SCHEMAS, "l")
    assert [e.rows for e in done] == [3] and ids(table) == [1, 3, 4]
    warehouse.stage_feed(stack(rows(spark, 9, part="b"), event(spark, "done_table", part="b")), SCHEMAS, "l")
    assert ids(table) == [1, 3, 4] and table.versions().filter("op = 'append'").count() == 1


def test_tables_of_a_staged_feed_complete_on_their_own(spark, warehouse):
    feed = stack(rows(spark, 1), event(spark, "done_table"), event(spark, "done_sharded"), rows(spark, 5, table="u"), event(spark, "done_sharded", table="u"))
    assert [e.table for e in warehouse.stage_feed(feed, SCHEMAS, "l")] == ["t"]
    assert ids(warehouse.table("ns", "t")) == [1] and ids(warehouse.table("ns", "u")) == []


def test_all_parts_without_rows(spark, warehouse):
    feed = stack(event(spark, "done_table", part="a"), event(spark, "done_sharded", parts=["a"]))
    assert [e.rows for e in warehouse.stage_feed(feed, SCHEMAS, "l")] == [0] and ids(warehouse.table("ns", "t")) == []


def test_transforms_derive_the_schema(spark, warehouse):
    text = "select id * 2 as twice, concat(note, '!') as note, array(id) as ids from {source} where id > 1"
    warehouse.load_feed(stack(rows(spark, 1, 2, 3), rows(spark, 9, table="u")), SCHEMAS, "x", transforms=[Transform(text, ("ns.t",), ("twice",))])
    table = warehouse.table("ns", "t")
    assert sorted((r.twice, r.note) for r in table.read().collect()) == [(4, "n2!"), (6, "n3!")]
    assert table.identifier_columns() == ["twice"] and ids(warehouse.table("ns", "u")) == [9]
    warehouse.load_feed(rows(spark, 5), SCHEMAS, "y", transforms=[Transform(text)])
    assert table.count() == 3


def test_two_tables_may_not_go_into_one(spark, warehouse):
    with pytest.raises(ValueError):
        warehouse.load_feed(stack(rows(spark, 1), rows(spark, 2, table="u")), SCHEMAS, "x", transforms=[Transform("select * from {source}", into=("ns", "v"))])


def test_a_transform_must_read_its_source(spark, warehouse):
    with pytest.raises(ValueError):
        warehouse.load_feed(rows(spark, 1), SCHEMAS, "x", transforms=[Transform("select 1 as one")])
