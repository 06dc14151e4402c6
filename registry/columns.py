"""Projection, routing and conversion of columns; JSON documents and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import (
    EVENT_SCHEMAS,
    NAMESPACE,
    declared,
    event_feed,
    given,
    new_warehouse,
    query,
    stack,
)
from tableload.functions import json as documents
from tableload.functions.names import default_namespace as with_default
from tableload.functions.types import ColSchema, from_struct_type, identifier_columns as identifiers, to_struct_type
from tableload.operators import conform as shaping
from tableload.operators.feed import control_events, feed_summary, route, row_events
from tableload.operators.feed import split_events as split
from tableload.operators.messages import bad_messages as unparsed
from tableload.operators.messages import dedupe_messages as dedupe
from tableload.operators.messages import parse_messages as parse
from tableload.operators.transform import transform_tables

# -- feeds ------------------------------------------------------------------------------------------


def _mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a feed in which the errors are control events."""
    events = given(spark, sf_dir, "events")
    rows = event_feed(events.filter("event_type <> 'error'"))
    control = control_events(
        events.filter("event_type = 'error'"), F.lit("done_table"), F.lit("shop"), F.col("event_type")
    )
    return rows.unionByName(control)


@query(
    """
    SELECT CASE WHEN event_type = 'error' THEN 'control' ELSE 'row' END AS side,
           CASE WHEN event_type = 'error' THEN 'done_table' ELSE 'insert' END AS kind,
           event_type AS "table", count(*) AS rows
    FROM events GROUP BY ALL
    """
)
def split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, control = split(_mixed_feed(spark, sf_dir))
    sides = [feed_summary(part).withColumn("side", F.lit(side)) for side, part in (("row", rows), ("control", control))]
    return stack(sides).select("side", "kind", "table", "rows")


@query("SELECT event_id, event_type AS \"table\" FROM events WHERE event_type <> 'error'")
def stream_row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_events(_mixed_feed(spark, sf_dir)).select(
        F.try_variant_get(F.get("column_values", F.lit(0)), "$", "bigint").alias("event_id"), "table"
    )


@query("SELECT event_type AS \"table\", event_id, ts, user_id, value, props FROM events")
def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(event_feed(given(spark, sf_dir, "events")), EVENT_SCHEMAS)
    columns = ["event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value", "props"]
    return stack([df.select(F.lit(name).alias("table"), *columns) for (_, name), df in routed.items()])


@query(
    """
    SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 'streaming' ELSE event_type END AS namespace
    FROM events
    """
)
def default_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    given_name = F.when(kind == "error", F.lit("")).when(kind != "view", kind)
    return given(spark, sf_dir, "events").select(
        "event_id", with_default(given_name, "streaming").alias("namespace")
    )


# -- shape ------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, NULL::VARCHAR AS missing, NULL::BIGINT AS absent FROM customer")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = to_struct_type(
        [
            ColSchema("c_custkey", "int64"),
            ColSchema("c_name", "string"),
            ColSchema("missing", "string"),
            ColSchema("absent", "uint32"),
        ]
    )
    return shaping.align_columns(given(spark, sf_dir, "customer"), target)


@query("SELECT event_id, user_id AS _partition_tr FROM events")
def reserved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("_partition"))
    table = new_warehouse(spark, "reserved").table(NAMESPACE, "events")
    table.load(rows, [ColSchema("event_id", "int64"), ColSchema("_partition", "int64")])
    return table.read()


@query(
    """
    SELECT 'l_orderkey,l_linenumber' AS key_columns, count(*) AS repeated_keys, sum(rows)::BIGINT AS rows_in_them
    FROM (SELECT count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """
)
def identifier_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = declared(spark, sf_dir, "lineitem", ("l_orderkey", "l_linenumber"))
    keys = identifiers(to_struct_type(cols + [ColSchema("optional_key", "string", primary_key=True)]))
    repeated = shaping.duplicate_keys(given(spark, sf_dir, "lineitem"), keys)
    return repeated.agg(
        F.lit(",".join(keys)).alias("key_columns"),
        F.count(F.lit(1)).alias("repeated_keys"),
        F.sum("rows").alias("rows_in_them"),
    )


@query(
    """
    SELECT 'event_id' AS column_name, 0::BIGINT AS missing
    UNION ALL SELECT 'user_id', count(*) FILTER (event_type = 'error') FROM events
    UNION ALL SELECT 'absent', count(*) FROM events
    """
)
def required_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "props"
    )
    cols = [
        ColSchema("event_id", "int64", primary_key=True, required=True),
        ColSchema("user_id", "int64", required=True),
        ColSchema("absent", "string", required=True),
        ColSchema("props", "string"),
    ]
    return shaping.required_check(rows, cols)


# -- conversion -------------------------------------------------------------------------------------

_SCHEMA_MAP = (
    ("int64", "bigint"),
    ("int32", "int"),
    ("int16", "int"),
    ("int8", "int"),
    ("uint64", "bigint"),
    ("uint32", "bigint"),
    ("uint16", "int"),
    ("uint8", "int"),
    ("float32", "float"),
    ("float64", "double"),
    ("bytes", "binary"),
    ("string", "string"),
    ("boolean", "boolean"),
    ("date", "date"),
    ("datetime", "timestamp"),
    ("timestamp", "timestamp"),
    ("interval", "string"),
    ("any", "string"),
)


@query(
    "SELECT v.*, n.rows AS present FROM (VALUES "
    + ", ".join(f"('c_{c}', '{c}', '{s}')" for c, s in _SCHEMA_MAP)
    + ") v(column_name, data_type, stored_type), (SELECT count(*) AS rows FROM lineitem) n"
)
def schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {"bytes": "cast(l_returnflag as binary)", "date": "l_shipdate", "datetime": "l_shipdate", "timestamp": "l_shipdate"}
    rows = given(spark, sf_dir, "lineitem").selectExpr(
        *[f"{source.get(c, 'l_linenumber')} as c_{c}" for c, _ in _SCHEMA_MAP]
    )
    table = new_warehouse(spark, "types").table(NAMESPACE, "types")
    table.load(rows, [ColSchema(f"c_{c}", c) for c, _ in _SCHEMA_MAP])
    return shaping.describe_schema(table.read(), table.schema()).select(
        "column_name", "data_type", "stored_type", "present"
    )


# whole numbers as text: some not numbers, some with a fraction of zero, some with another fraction
_INT_TEXT = """
    case event_type when 'error' then concat('x', event_id) when 'view' then concat(n, '.0')
    when 'signup' then concat(n, '.5') when 'purchase' then concat('+', abs(n)) else cast(n as string) end
"""
_SIGNED = "case when user_id % 2 = 0 then event_id else -event_id end"
_INT_SQL = "CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL WHEN 'purchase' THEN abs(n) ELSE n END"


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = given(spark, sf_dir, "events").selectExpr("*", f"{_SIGNED} as n")
    return signed.selectExpr("event_id", "event_type", "n", f"{_INT_TEXT} as as_text", "value * n as as_number")


def _converted(df: DataFrame, source: str, kinds: tuple[str, ...], on_error: str = "default") -> DataFrame:
    wide = df.select("event_id", *[F.col(source).alias(k) for k in kinds])
    cols = [ColSchema("event_id", "int64", required=True), *[ColSchema(k, k) for k in kinds]]
    return shaping.conform(wide, cols, on_error)


def _ranged(value: str, low: int, high: int, out: str) -> str:
    return f"coalesce(CASE WHEN {value} BETWEEN {low} AND {high} THEN {value} END, 0)::{out}"


def _int_sql(ranges: dict[str, tuple[int, int, str]]) -> str:
    text = ", ".join(f"{_ranged('t', *r)} AS {k}" for k, r in ranges.items())
    number = ", ".join(f"{_ranged('d', *r)} AS {k}" for k, r in ranges.items())
    base = f"SELECT *, {_INT_SQL} AS t, trunc(value * n) AS d FROM (SELECT *, {_SIGNED} AS n FROM events)"
    return (
        f"SELECT 'text' AS origin, event_id, {text} FROM ({base}) "
        f"UNION ALL SELECT 'number', event_id, {number} FROM ({base})"
    )


_SIGNED_RANGES = {
    "int8": (-128, 127, "INTEGER"),
    "int16": (-32768, 32767, "INTEGER"),
    "int32": (-(2**31), 2**31 - 1, "INTEGER"),
    "int64": (-(2**62), 2**62, "BIGINT"),
}
_UNSIGNED_RANGES = {
    "uint8": (0, 255, "INTEGER"),
    "uint16": (0, 65535, "INTEGER"),
    "uint32": (0, 2**32 - 1, "BIGINT"),
    "uint64": (0, 2**62, "BIGINT"),
}


def _whole(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> DataFrame:
    numbers = _numbers(spark, sf_dir)
    return stack(
        [
            _converted(numbers, column, kinds).withColumn("origin", F.lit(origin))
            for origin, column in (("text", "as_text"), ("number", "as_number"))
        ]
    )


@query(_int_sql(_SIGNED_RANGES))
def conform_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(spark, sf_dir, tuple(_SIGNED_RANGES))


@query(_int_sql(_UNSIGNED_RANGES))
def conform_uints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(spark, sf_dir, tuple(_UNSIGNED_RANGES))


_FLOAT_TEXT = """
    case event_type when 'error' then concat(value, 'd') when 'view' then 'NaN' when 'signup' then '-Inf'
    when 'purchase' then ' 1' else cast(value as string) end
"""


@query(
    """
    SELECT event_id,
      CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 'nan'::DOUBLE WHEN 'signup' THEN '-inf'::DOUBLE
        WHEN 'purchase' THEN 0 ELSE value END AS float64,
      CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 'nan'::FLOAT WHEN 'signup' THEN '-inf'::FLOAT
        WHEN 'purchase' THEN 0 ELSE value::FLOAT END::DOUBLE AS float32,
      value::FLOAT::DOUBLE AS narrowed
    FROM events
    """
)
def conform_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").selectExpr(
        "event_id", f"{_FLOAT_TEXT} as float64", f"{_FLOAT_TEXT} as float32", "value as narrowed"
    )
    cols = [
        ColSchema("event_id", "int64"),
        ColSchema("float64", "float64"),
        ColSchema("float32", "float32"),
        ColSchema("narrowed", "float32"),
    ]
    wide = shaping.conform(rows, cols, "default")
    return wide.select("event_id", "float64", *[F.col(c).cast("double").alias(c) for c in ("float32", "narrowed")])


@query("SELECT doc_id, md5(text) AS kept, NULL::VARCHAR AS from_text, NULL::VARCHAR AS from_number FROM documents")
def conform_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "documents").selectExpr(
        "doc_id", "cast(text as binary) as kept", "text as from_text", "n_chars as from_number"
    )
    cols = [ColSchema("doc_id", "int64"), *[ColSchema(c, "bytes") for c in ("kept", "from_text", "from_number")]]
    out = shaping.conform(rows, cols, "default")
    return out.select(
        "doc_id",
        F.md5("kept").alias("kept"),
        F.col("from_text").cast("string").alias("from_text"),
        F.col("from_number").cast("string").alias("from_number"),
    )


@query(
    r"""
    SELECT l_orderkey, l_linenumber, regexp_replace(l_extendedprice::VARCHAR, '\.0$', '') AS price,
           regexp_replace((l_quantity * 100000000)::BIGINT::VARCHAR, '\.0$', '') AS large,
           CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END AS flag,
           l_orderkey::VARCHAR AS number, l_returnflag AS kept
    FROM lineitem
    """
)
def conform_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice as price",
        "l_quantity * 100000000 as large",
        "l_quantity > 25 as flag",
        "l_orderkey as number",
        "l_returnflag as kept",
    )
    cols = [ColSchema("l_orderkey", "int64"), ColSchema("l_linenumber", "int32")]
    return shaping.conform(
        rows, cols + [ColSchema(c, "string") for c in ("price", "large", "flag", "number", "kept")], "default"
    )


@query(
    """
    SELECT event_id, '"' || event_type || '"' AS text_json, user_id::VARCHAR AS number_json,
           '[' || user_id || ',' || event_id || ']' AS list_json,
           '{"user":' || user_id || ',"type":' || CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || event_type || '"' END || '}'
             AS struct_json,
           '{"' || event_type || '":' || user_id || '}' AS map_json,
           CASE WHEN event_type <> 'error' THEN 'true' END AS flag_json
    FROM events
    """
)
def any_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type as text_json",
        "user_id as number_json",
        "array(user_id, event_id) as list_json",
        "named_struct('user', user_id, 'type', nullif(event_type, 'error')) as struct_json",
        "map(event_type, user_id) as map_json",
        "case when event_type <> 'error' then true end as flag_json",
    )
    kinds = [ColSchema(c, "any") for c in rows.columns if c != "event_id"]
    return shaping.conform(rows, [ColSchema("event_id", "int64"), *kinds])


@query(
    """
    SELECT event_id, event_type IN ('view', 'click') AS from_text, value <> 0 AS from_number, value > 50 AS kept
    FROM events
    """
)
def conform_bools(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = "case event_type when 'view' then 'T' when 'click' then '1' when 'error' then 'yes' when 'signup' then 'False' else 'f' end"
    rows = given(spark, sf_dir, "events").selectExpr(
        "event_id", f"{words} as from_text", "value as from_number", "value > 50 as kept"
    )
    return shaping.conform(
        rows, [ColSchema("event_id", "int64"), *[ColSchema(c, "boolean") for c in rows.columns[1:]]], "default"
    )


@query(
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN DATE '1970-01-01' WHEN 'view' THEN DATE '1970-01-01'
             ELSE ts::DATE END AS from_text,
           (DATE '1970-01-01' + user_id::INTEGER) AS from_days, ts::DATE AS from_time,
           (TIMESTAMP '1969-12-31 12:00:00' - to_hours(user_id::INTEGER))::DATE AS before_epoch
    FROM events
    """
)
def conform_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "case event_type when 'error' then date_format(ts, 'dd/MM/yyyy') when 'view' then '2024-02-30' else date_format(ts, 'yyyy-MM-dd') end"
    rows = given(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{text} as from_text",
        "user_id as from_days",
        "ts as from_time",
        "timestamp'1969-12-31 12:00:00Z' - make_interval(0, 0, 0, 0, cast(user_id as int)) as before_epoch",
    )
    return shaping.conform(
        rows, [ColSchema("event_id", "int64"), *[ColSchema(c, "date") for c in rows.columns[1:]]], "default"
    )


@query(
    """
    SELECT event_id, CASE event_type
             WHEN 'error' THEN TIMESTAMP '1970-01-01' WHEN 'view' THEN date_trunc('day', ts)
             WHEN 'signup' THEN date_trunc('second', ts) - INTERVAL 2 HOUR ELSE date_trunc('second', ts) END AS from_text,
           date_trunc('milliseconds', ts) AS from_millis, ts AS from_time
    FROM events
    """
)
def conform_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        case event_type when 'error' then date_format(ts, 'yyyy-MM-dd HH:mm') when 'view' then date_format(ts, 'yyyy-MM-dd')
        when 'signup' then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'") when 'click' then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
        else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end
    """
    rows = given(spark, sf_dir, "events").selectExpr(
        "event_id", f"{text} as from_text", "unix_millis(cast(ts as timestamp)) as from_millis", "ts as from_time"
    )
    kinds = rows.columns[1:]
    out = shaping.conform(rows, [ColSchema("event_id", "int64"), *[ColSchema(c, "timestamp") for c in kinds]], "default")
    return out.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in kinds])


@query(
    """
    SELECT vec_id, NULL::VARCHAR AS list_from_text, true AS list_kept, NULL::VARCHAR AS struct_from_number
    FROM embeddings
    """
)
def conform_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target types outside the canonical list take only values of that very type."""
    source = given(spark, sf_dir, "embeddings")
    native = {c.name: c for c in from_struct_type(source.schema)}["embedding"].native
    struct_type = source.select(F.struct("label")).schema.fields[0].dataType
    rows = source.select(
        "vec_id", F.lit("[1]").alias("list_from_text"), F.col("embedding").alias("list_kept"), F.col("label").alias("struct_from_number")
    )
    cols = [
        ColSchema("vec_id", "int64"),
        ColSchema("list_from_text", "any", native=native),
        ColSchema("list_kept", "any", native=native),
        ColSchema("struct_from_number", "any", native=struct_type),
    ]
    out = shaping.conform(rows, cols, "default")
    return out.select(
        "vec_id",
        F.to_json("list_from_text").alias("list_from_text"),
        F.col("list_kept").isNotNull().alias("list_kept"),
        F.to_json("struct_from_number").alias("struct_from_number"),
    )


@query(
    """
    SELECT 'as_int' AS column_name, 'int64' AS data_type, count(*) AS present,
           count(*) FILTER (event_type IN ('error', 'signup')) AS failed FROM events
    UNION ALL SELECT 'as_date', 'date', count(*) FILTER (event_type <> 'view'), count(*) FILTER (event_type = 'error') FROM events
    UNION ALL SELECT 'as_bytes', 'bytes', count(*), count(*) FROM events
    UNION ALL SELECT 'absent', 'string', 0, 0
    """
)
def conform_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = _numbers(spark, sf_dir).selectExpr(
        "as_text as as_int",
        "case event_type when 'error' then 'today' when 'view' then null else '2024-01-02' end as as_date",
        "as_text as as_bytes",
    )
    cols = [
        ColSchema("as_int", "int64"),
        ColSchema("as_date", "date"),
        ColSchema("as_bytes", "bytes"),
        ColSchema("absent", "string"),
    ]
    return shaping.conform_report(numbers, cols)


# -- messages and documents -------------------------------------------------------------------------

_MESSAGE = """
    case when event_type = 'error' then concat('{"id": "', event_id, '", "level"')
    else concat('{"id": "', event_id, '", "level": "', event_type, '", "value": ', value, ', "user": ', user_id, '}') end
"""
_MESSAGE_COLUMNS = [
    ColSchema("id", "int32", primary_key=True),
    ColSchema("level", "string"),
    ColSchema("value", "float64"),
    ColSchema("caller", "string"),
]


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").selectExpr(
        "'topic1' as _topic", "user_id as _partition", "event_id as _offset", "ts as _timestamp", f"{_MESSAGE} as value"
    )


@query(
    """
    SELECT event_id::INTEGER AS id, event_type AS level, value, NULL::VARCHAR AS caller,
           'topic1' AS _topic, user_id AS _partition, event_id AS _offset, ts AS _timestamp
    FROM events WHERE event_type <> 'error'
    """
)
def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_messages(spark, sf_dir), _MESSAGE_COLUMNS)


@query(
    """
    SELECT event_id::INTEGER AS id, user_id::VARCHAR AS rest_user, 2 AS rest_size
    FROM events WHERE event_type <> 'error'
    """
)
def parse_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [c for c in _MESSAGE_COLUMNS if c.name != "value"]
    parsed = parse(_messages(spark, sf_dir), cols, rest=True, dedupe_keys=False)
    return parsed.select(
        "id", F.try_element_at("_rest", F.lit("user")).alias("rest_user"), F.size("_rest").alias("rest_size")
    )


@query("SELECT event_id AS _offset, '{\"id\": \"' || event_id || '\", \"level\"' AS value FROM events WHERE event_type = 'error'")
def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsed(_messages(spark, sf_dir)).select("_offset", "value")


@query(
    """
    SELECT DISTINCT event_id::INTEGER AS id, event_type AS level, user_id AS _partition, event_id AS _offset
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'click')
    WHERE event_type <> 'error'
    """
)
def dedupe_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = _messages(spark, sf_dir)
    clicks = once.filter(F.get_json_object("value", "$.level") == "click")
    messages = dedupe(once.unionByName(once).unionByName(clicks), ["_topic", "_partition", "_offset"])  # copies are not parsed
    return parse(messages, _MESSAGE_COLUMNS).select("id", "level", "_partition", "_offset")


def _price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line item, with an array of price levels in it."""
    level = "named_struct('unit', {c}, 'value', {v}, 'places', array(l_linestatus))"
    return given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        "to_json(named_struct('_id', l_orderkey, 'tiers', array("
        + level.format(c="l_returnflag", v="l_quantity")
        + ", "
        + level.format(c="'EUR'", v="l_discount")
        + "))) as document",
    )


_DOC_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
_DOC_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, {} FROM lineitem"
_LEVEL_SQL = "'{{\"unit\":\"' || {c} || '\",\"value\":' || {v}::VARCHAR || ',\"places\":[\"' || l_linestatus || '\"]}}'"
_LEVEL_1 = _LEVEL_SQL.format(c="l_returnflag", v="l_quantity")
_LEVEL_2 = _LEVEL_SQL.format(c="'EUR'", v="l_discount")


@query(_DOC_SQL.format(f"2 AS elements, {_LEVEL_1} AS first_element, {_LEVEL_2} AS second_element"))
def json_array_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _price_documents(spark, sf_dir).withColumn("raw", documents.json_array_raw(F.col("document"), "tiers"))
    return docs.select(
        *_DOC_KEYS,
        F.size("raw").alias("elements"),
        F.get("raw", F.lit(0)).alias("first_element"),
        F.get("raw", F.lit(1)).alias("second_element"),
    )


@query(_DOC_SQL.format("2 AS elements, l_quantity AS first_value, l_discount AS second_value"))
def json_array_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = documents.json_array_float(F.col("document"), "tiers", "value")
    docs = _price_documents(spark, sf_dir).withColumn("values", values)
    return docs.select(
        *_DOC_KEYS,
        F.size("values").alias("elements"),
        F.get("values", F.lit(0)).alias("first_value"),
        F.get("values", F.lit(1)).alias("second_value"),
    )


@query(_DOC_SQL.format("2 AS elements, l_returnflag || ',EUR' AS units_of_tiers"))
def json_array_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = documents.json_array_string(F.col("document"), "tiers", "unit")
    docs = _price_documents(spark, sf_dir).withColumn("values", values)
    return docs.select(
        *_DOC_KEYS, F.size("values").alias("elements"), F.array_join("values", ",").alias("units_of_tiers")
    )


@query(_DOC_SQL.format(f"'[' || {_LEVEL_1} || ',' || {_LEVEL_2} || ']' AS tiers_text, l_orderkey::VARCHAR AS id_as_string"))
def json_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _price_documents(spark, sf_dir)
    return docs.select(
        *_DOC_KEYS,
        documents.json_raw(F.col("document"), "tiers").alias("tiers_text"),
        documents.json_raw(F.col("document"), "_id").alias("id_as_string"),
    )


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE props END AS document FROM events")
def assume_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("props")).alias("document")
    )
    return rows.select("event_id", documents.assume_not_null(F.col("document")).alias("document"))


@query(
    """
    SELECT 'orders' AS "table", o_orderkey AS key, upper(o_orderstatus) || '-' || o_orderpriority AS label FROM orders
    UNION ALL SELECT 'customer', c_custkey, c_mktsegment FROM customer
    """
)
def sql_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        (NAMESPACE, "orders"): given(spark, sf_dir, "orders"),
        (NAMESPACE, "customer"): given(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label")
        ),
    }
    text = "select o_orderkey as key, upper(o_orderstatus) || '-' || o_orderpriority as label from {source}"
    changed = transform_tables(tables, text, [f"{NAMESPACE}.orders"])
    return stack([df.select(F.lit(name).alias("table"), "key", "label") for (_, name), df in changed.items()])
