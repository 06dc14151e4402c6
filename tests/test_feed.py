"""Change feeds, and the transfers of relational tables, documents and messages."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tableload import ColSchema, canon_compare, from_struct_type, reconcile, route, split_events, table_to_changes, with_keys
from tableload.functions.json import assume_not_null, json_array_float, json_array_raw, json_array_string, json_raw
from tableload.operators.feed import FEED_SCHEMA, control_events, feed_columns, include_tables, restore_values
from tableload.operators.messages import bad_messages, dedupe_messages, parse_messages
from tableload.operators.transform import sql_transform, transform_tables
from tableload.operators.verify import count_rows, difference_rows, fingerprint, load_stats, observed
from tableload.sources.external import document_collection, jdbc_options, message_files

COLS = [ColSchema("id", "int64", primary_key=True, required=True), ColSchema("name", "string", required=True)]


def feed_of(spark, rows):
    """Feed rows from (kind, namespace, table, names, JSON values)."""
    df = spark.createDataFrame(rows, "kind string, namespace string, table string, names array<string>, vals array<string>")
    return df.select(
        "kind",
        "namespace",
        "table",
        F.lit("0").alias("load_part"),
        F.lit("").alias("snapshot_id"),
        F.lit(None).cast("bigint").alias("commit_time"),
        F.lit(None).cast("bigint").alias("lsn"),
        F.col("names").alias("column_names"),
        F.transform("vals", lambda v: F.try_parse_json(v)).alias("column_values"),
    )


def test_changes_carry_names_values_and_position(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None), (2, "b")], "id int, name string").coalesce(1).write.parquet(path)
    feed = table_to_changes(spark.read.parquet(path), "ns", "t", "snap", 1_700_000_000_000_000_000, F.col("_metadata.row_index"))
    assert feed.schema.names == FEED_SCHEMA.names
    first = feed.orderBy("lsn").first()
    assert (first["kind"], first["namespace"], first["table"], first["lsn"]) == ("insert", "ns", "t", 0)
    assert first["commit_time"] == 1_700_000_000_000_000_000 and first["column_names"] == ["id", "name"]
    assert first["column_values"][1] is None


def test_values_are_found_by_name(spark):
    feed = feed_of(
        spark,
        [
            ("insert", "a", "t", ["id", "name"], ["1", '"in order"']),
            ("insert", "a", "t", ["name", "id"], ['"swapped"', "2"]),
            ("insert", "a", "t", ["id"], ["3"]),
            ("insert", "a", "t", ["id", "name", "extra"], ["4", '"extra"', "0"]),
            ("insert", "a", "t", ["id", "id", "name"], ["5", "99", '"first wins"']),
            ("insert", "a", "t", ["id", "name"], ["6"]),
            ("insert", "a", "t", ["id", "name"], ["7", "null"]),
        ],
    )
    rows = {r["id"]: r["name"] for r in restore_values(feed, [ColSchema("id", "int64"), ColSchema("name", "string")]).collect()}
    assert rows == {1: "in order", 2: "swapped", 3: None, 4: "extra", 5: "first wins", 6: None, 7: None}
    assert feed_columns(feed, COLS).columns == ["id", "name"]


def test_restore_gives_back_every_type(spark):
    df = spark.sql(
        """select 1L as l, 2 as i, 1.5f as f, 2.5D as d, date'2024-01-02' as da, timestamp'2024-01-02 03:04:05.123456' as ts,
        timestamp_ntz'2024-01-02 03:04:05' as n, 's' as s, true as b, X'00FF' as bin, 1.50BD as de, array(1, null) as a,
        named_struct('x', 1, 'y', array('z')) as st, cast(null as bigint) as nothing"""
    )
    back = restore_values(table_to_changes(df, "ns", "t"), from_struct_type(df.schema))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert canon_compare(df, back).first()["same_rows"]


def test_maps_go_through_json(spark):
    df = spark.sql("select map(1L, 2.50BD) as m, array(map('a', 1)) as am")
    rows = restore_values(table_to_changes(df, "ns", "t"), [ColSchema("m", "any"), ColSchema("am", "any")]).first()
    assert tuple(rows) == ('{"1":2.5}', '[{"a":1}]')


def test_split_route_and_include(spark):
    feed = feed_of(
        spark,
        [
            ("insert", "a", "t", ["id", "name"], ["1", '"x"']),
            ("insert", "", "t", ["id", "name"], ["2", '"y"']),
            ("update", "a", "t", ["id", "name"], ["3", '"z"']),
            ("done_table", "a", "t", [], []),
            ("drop", "b", "t", [], []),
            (None, "b", "t", [], []),
        ],
    )
    rows, control = split_events(feed)
    assert rows.count() == 3 and control.count() == 3
    routed = route(feed, {("a", "t"): COLS, ("dflt", "t"): COLS}, "dflt")
    assert sorted(r["id"] for r in routed[("a", "t")].collect()) == [1, 3]
    assert [r["id"] for r in routed[("dflt", "t")].collect()] == [2]
    assert include_tables(feed, ["a.t"]).count() == 3
    assert include_tables(feed, ["t"]).count() == 1
    assert include_tables(feed, None).count() == 6


@pytest.mark.parametrize("stage", [True, False])
def test_bulk_load_of_several_tables(spark, warehouse, stage):
    feed = feed_of(
        spark,
        [("insert", ns, t, ["id", "name"], [str(i), '"n"']) for i, (ns, t) in enumerate([("a", "x"), ("a", "y"), ("", "z")] * 4)]
        + [("done_table", "a", "x", [], []), ("done_sharded", "a", "x", [], [])],
    )
    schemas = {("a", "x"): COLS, ("a", "y"): COLS, ("", "z"): COLS}
    entries = warehouse.load_feed(feed, schemas, "one", props={"p": "1"}, stage=stage)
    assert sorted((e.namespace, e.table, e.rows) for e in entries) == [("", "z", 4), ("a", "x", 4), ("a", "y", 4)]
    again = warehouse.load_feed(feed, schemas, "one", stage=stage)
    assert [e.seq for e in again] == [e.seq for e in entries], "a load that is published is not repeated"
    assert sum(r["rows"] for r in warehouse.list_tables().collect()) == 12
    assert warehouse.table("a", "x").identifier_columns() == ["id"]


def test_control_events_act_before_rows(spark, warehouse):
    table = warehouse.table("a", "t")
    table.load(spark.createDataFrame([(1, "old")], "id bigint, name string"), COLS)
    cleanup = control_events(spark.range(1), F.lit("drop"), F.lit("a"), F.lit("t"))
    rows = feed_of(spark, [("insert", "a", "t", ["id", "name"], ["2", '"new"'])])
    warehouse.load_feed(cleanup.unionByName(rows), {("a", "t"): COLS})
    assert [tuple(r) for r in table.read().collect()] == [(2, "new")]


@pytest.mark.parametrize("kind", ["update", "delete"])
def test_changes_other_than_inserts_are_refused(spark, warehouse, kind):
    feed = feed_of(spark, [("insert", "a", "t", ["id", "name"], ["1", '"x"']), (kind, "a", "t", ["id"], ["1"])])
    with pytest.raises(ValueError, match="only inserts"):
        warehouse.load_feed(feed, {("a", "t"): COLS})
    assert not warehouse.table_exists("a", "t")


def test_undeclared_tables_are_refused(spark, warehouse):
    feed = feed_of(spark, [("insert", "a", "t", ["id"], ["1"])])
    with pytest.raises(ValueError, match="no schema declared .* a.t"):
        warehouse.load_feed(feed, {})


def test_feed_of_many_tables_in_a_batch_is_staged(spark, warehouse):
    names = [f"t{i}" for i in range(20)]
    feed = feed_of(spark, [("insert", "a", n, ["id", "name"], [str(i), '"n"']) for i, n in enumerate(names)])
    warehouse.append_batch(feed, {("a", n): COLS for n in names}, "batch")
    assert warehouse.list_tables("a").agg(F.sum("rows")).first()[0] == 20


# -- relational sources -----------------------------------------------------------------------------


def test_relational_edge_values(spark, warehouse):
    """Keys of several columns, tiny and huge numbers, NaN and infinities, null dates, fixed decimals."""
    schema = "id bigint, aid int, f float, d double, de decimal(10,2), i int, bi bigint, biu bigint, da date, ts timestamp_ntz, str string"
    day = dt.date(1999, 3, 4)
    rows = [
        (1, 0, 1.45e-10, 3.14e-100, Decimal("2.50"), -8388605, 2147483642, 9223372036854775804, dt.date(2005, 3, 4), dt.datetime(2024, 1, 1), "hello, friend of mine"),
        (2, 1, 1.34e-10, None, None, -1294129412, 112412412421941041, 129491244912401240, day, None, "another hello"),
        (3, 4, 5.34e-10, None, Decimal("123"), 294129412, -784124124219410491, 129491098649360240, day, None, "third"),
        (100, 5, math.nan, math.nan, None, None, None, None, None, None, "100"),
        (101, 6, math.inf, math.inf, None, None, None, None, None, None, "101"),
        (102, 7, -math.inf, -math.inf, None, None, None, None, None, None, "102"),
    ] + [(200 + i, 10 + i, None, None, None, None, None, None, day, None, f"row {i}") for i in range(10)]
    source = spark.createDataFrame(rows, schema)
    table = warehouse.table("public", "__test")
    table.load(source, with_keys(from_struct_type(source.schema), ["aid", "str", "id"]), nested="native")
    assert table.count() == 16 and set(table.identifier_columns()) == {"id", "aid", "str"}
    assert canon_compare(source, table.read()).first().asDict() == {"same_schema": True, "same_rows": True, "missing": 0, "extra": 0}


def test_relational_limits_and_blanks(spark, warehouse):
    rows = [
        (1, 0, 0, 0, 0, 0.0, 0.0, False, " " * 10, "", dt.date(1970, 1, 1), dt.datetime(1900, 1, 1, 1), 1901),
        (2, 127, 32767, 8388607, 2**63 - 1, 1.1, 1.1, True, "char1char1", "text", dt.date(1999, 12, 31), dt.datetime(1999, 12, 31, 23, 59, 59, 999999), 1999),
        (3, -128, -32768, -8388608, -(2**63), 1.1, 1.1, True, 'sant" \' CL', "'CLAWS\\", dt.date(2038, 12, 31), dt.datetime(2106, 2, 7, 6, 28, 15, 999999), 2155),
    ]
    source = spark.createDataFrame(rows, "i int, ti byte, si short, mi int, bi bigint, f float, dp double, b boolean, c10 string, tx string, d date, dt timestamp_ntz, y int")
    cols = [ColSchema("i", "int32", True, True), ColSchema("ti", "int8"), ColSchema("si", "int16"), *from_struct_type(source.schema)[3:]]
    table = warehouse.table("source", "mysql_snapshot")
    table.load(source, cols)
    assert table.count() == 3
    wide = source.withColumn("ti", F.col("ti").cast("int")).withColumn("si", F.col("si").cast("int"))
    assert canon_compare(wide, table.read()).first()["same_rows"]


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10240"}
    split = jdbc_options("jdbc:x", "t", "id", (1, 100), 4, properties={"user": "u"})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


# -- documents --------------------------------------------------------------------------------------

DOCUMENT = """{"_id":"doc-7","tiers":[{"unit":"kg","value":0.25,"places":["A1"]},{"unit":"kg","value":0.5,"places":["B2","C3"]}]}"""


def test_flatten_a_document(spark, warehouse, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(DOCUMENT,)], "value string").write.text(path)
    docs = document_collection(spark, path)
    tables = transform_tables(
        {("db", "test_data2"): docs, ("db", "other"): docs}, "select _id, document as kept from {source}", ["db.test_data2"]
    )
    assert tables[("db", "other")].columns == ["_id", "document"]
    doc = F.col("kept")
    flat = tables[("db", "test_data2")].select(
        "_id",
        json_array_raw(doc, "tiers").alias("tier_texts"),
        json_array_float(doc, "tiers", "value").alias("values_of_tiers"),
        json_array_string(doc, "tiers", "unit").alias("units_of_tiers"),
        json_raw(assume_not_null(doc), "tiers").alias("tiers_text"),
    )
    table = warehouse.table("db", "test_data2")
    table.load(flat, nested="native")
    first, second = (
        '{"unit":"kg","value":0.25,"places":["A1"]}',
        '{"unit":"kg","value":0.5,"places":["B2","C3"]}',
    )
    assert table.read().first().asDict() == {
        "_id": "doc-7",
        "tier_texts": [first, second],
        "values_of_tiers": [0.25, 0.5],
        "units_of_tiers": ["kg", "kg"],
        "tiers_text": f"[{first},{second}]",
    }


def test_json_edges(spark):
    docs = [
        ('{"a":[{"value":1.50},5,"x",null,"{\\"value\\":3}",[1]]}', ['{"value":1.5}', "5", '"x"', "null", '"{\\"value\\":3}"', "[1]"]),
        ('{"a":["{"]}', ['"{"']),
        ('{"a":[]}', []),
        ('{"a":5}', None),
        ('{"a":"s"}', None),
        ('{"b":1}', None),
        ("not json", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(docs)], "i int, d string")
    out = df.select(
        "i",
        json_array_raw(F.col("d"), "a").alias("arr"),
        json_raw(F.col("d"), "a").alias("raw"),
        json_array_float(F.col("d"), "a", "value").alias("numbers"),
        assume_not_null(F.col("d")).alias("kept"),
    ).orderBy("i").collect()
    assert [r["arr"] for r in out] == [e for _, e in docs]
    assert out[3]["raw"] == "5" and out[4]["raw"] == '"s"' and out[5]["raw"] is None
    assert out[0]["numbers"][:4] == [1.5, None, None, None]
    assert out[7]["kept"] == ""


def test_sql_transform_needs_its_source(spark):
    with pytest.raises(ValueError):
        sql_transform(spark.range(1), "select 1")


# -- messages ---------------------------------------------------------------------------------------

MESSAGE_COLS = [
    ColSchema("id", "int32", primary_key=True),
    ColSchema("level", "string"),
    ColSchema("caller", "string"),
    ColSchema("msg", "string"),
]


def test_messages_of_a_topic(spark, warehouse, tmp_path):
    path = str(tmp_path / "topic1")
    values = [(f"key-{i}", f'{{"id": "{i}", "level": "info", "caller": "main", "msg": "started"}}') for i in range(5)]
    spark.createDataFrame(values, "key string, value string").repartition(2).write.parquet(path)
    messages = message_files(spark, path, "topic1", stream=False)
    parsed = parse_messages(messages, MESSAGE_COLS)
    twice = dedupe_messages(parsed.unionByName(parsed), ["_topic", "_partition", "_offset"])
    table = warehouse.table("streaming", "topic1")
    table.load(twice)
    assert table.count() == 5
    assert "_partition_tr" in table.schema().names
    row = table.read().orderBy("id").first()
    assert (row["id"], row["level"], row["caller"], row["msg"]) == (0, "info", "main", "started")
    assert row["_partition_tr"].endswith(".parquet")


def test_rest_bad_and_odd_messages(spark):
    texts = ['{"id":"1","level":"a","x":{"y":[1]},"z":null}', "[1]", "5", '{"id":', "", None, '{"id":true,"level":7}', '{"level":null}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good = parse_messages(df, MESSAGE_COLS[:2], rest=True).collect()
    assert [(r["id"], r["level"]) for r in good] == [(1, "a"), (1, "7"), (None, None)]
    assert good[0]["_rest"] == {"x": '{"y":[1]}', "z": None}
    assert bad_messages(df).count() == 5


# -- verification -----------------------------------------------------------------------------------


def test_reconcile(spark):
    expected = spark.createDataFrame([("a", "x", 3), ("a", "y", 1)], "namespace string, table string, rows bigint")
    actual = spark.createDataFrame([("a", "x", 2), ("a", "z", 5)], "namespace string, table string, rows bigint")
    found = {r["table"]: (r["expected"], r["actual"], r["difference"]) for r in reconcile(expected, actual).collect()}
    assert found == {"x": (3, 2, -1), "y": (1, 0, -1), "z": (0, 5, 5)}
    assert count_rows(spark.range(3), "a", "x").first()["rows"] == 3


def test_compare_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2)], "v string, k int")
    assert canon_compare(a, b).first().asDict() == {"same_schema": True, "same_rows": False, "missing": 1, "extra": 1}
    assert sorted(r["side"] for r in difference_rows(a, b).collect()) == ["extra", "missing"]
    assert canon_compare(a, b.drop("v")).first().asDict() == {"same_schema": False, "same_rows": False, "missing": 3, "extra": 3}
    assert fingerprint(a).first() == fingerprint(a.select("v", "k").orderBy(F.desc("k"))).first()
    assert fingerprint(a).first() != fingerprint(b).first()
    with_map = spark.sql("select map('a', 1) as m, parse_json('[1]') as j")
    assert canon_compare(with_map, with_map).first()["same_rows"]


def test_stats_and_observation(spark, tmp_path):
    df = spark.createDataFrame([("ä", 1, None), ("bc", 2, 5)], "s string, i int, l bigint")
    assert load_stats(df).first().asDict() == {"rows": 2, "bytes": 2 + 4 + 2 + 4 + 8}
    seen_df, seen = observed(df)
    seen_df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 2, "bytes": 20}


def test_native_type_objects():
    assert FEED_SCHEMA["column_values"].dataType == T.ArrayType(T.VariantType())
