"""Reading, describing, listing and counting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import (
    NAMESPACE,
    TABLES,
    catalog,
    declared,
    given,
    land,
    lineitem_by_year,
    new_warehouse,
    one_row,
    orders_by_status,
    query,
    registered,
    stack,
)
from tableload.functions.names import id_name, id_namespace, join_id
from tableload.functions.types import ColSchema, canonical_type, value_type_name
from tableload.operators.conform import describe_schema
from tableload.operators.feed import restore_values as restore
from tableload.operators.feed import table_to_changes as changes_of
from tableload.operators.messages import parse_messages
from tableload.plans.table import VersionNotFound
from tableload.session import scratch_dir
from tableload.sources.external import document_collection, message_files
from tableload.streaming.append import stream_table

_COUNTS = " UNION ALL ".join(
    f"SELECT 'sf' AS namespace, '{t}' AS \"table\", count(*) AS rows, false AS is_view FROM {t}" for t in TABLES
)


@query("SELECT * FROM orders")
def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered(spark, sf_dir, "orders").read()


@query(
    """
    SELECT c_custkey AS row_key, 'insert' AS kind, 'sf' AS namespace, 'customer' AS "table",
           column_name, text_value, number_value
    FROM (
      SELECT c_custkey, 'c_custkey' AS column_name, NULL AS text_value, c_custkey::DOUBLE AS number_value FROM customer
      UNION ALL SELECT c_custkey, 'c_name', c_name, NULL FROM customer
      UNION ALL SELECT c_custkey, 'c_nationkey', NULL, c_nationkey::DOUBLE FROM customer
      UNION ALL SELECT c_custkey, 'c_acctbal', NULL, c_acctbal FROM customer
      UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, NULL FROM customer)
    """
)
def table_to_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = changes_of(given(spark, sf_dir, "customer"), NAMESPACE, "customer", lsn=F.col("_metadata.row_index"))
    cells = feed.select(
        F.try_variant_get(F.get("column_values", F.lit(0)), "$", "bigint").alias("row_key"),
        "kind",
        "namespace",
        "table",
        F.explode(F.arrays_zip(F.col("column_names"), F.col("column_values"))).alias("cell"),
    )
    value = F.col("cell.column_values")
    is_text = F.schema_of_variant(value) == "STRING"
    return cells.select(
        "row_key",
        "kind",
        "namespace",
        "table",
        F.col("cell.column_names").alias("column_name"),
        F.when(is_text, F.try_variant_get(value, "$", "string")).alias("text_value"),
        F.when(~is_text, F.try_variant_get(value, "$", "double")).alias("number_value"),
    )


@query(
    """
    SELECT '1' AS snapshot_id, count(*) AS rows, count(*) AS positions, true AS timed FROM orders
    UNION ALL SELECT '2', 2 * count(*), 2 * count(*), true FROM orders
    """
)
def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions as change feeds: their number, their commit time, and a position that is unique in the table."""
    table = new_warehouse(spark, "changes").table(NAMESPACE, "orders")
    for _ in range(2):
        table.load(given(spark, sf_dir, "orders"))
    return stack(
        [
            table.changes(as_of=version)
            .groupBy("snapshot_id", "load_part", "lsn", (F.col("commit_time") > 0).alias("timed"))
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("snapshot_id", "timed")
            .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("positions"))
            for version in (1, 2)
        ]
    )


@query(
    """
    SELECT o_orderkey, mark FROM (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN NULL ELSE o_orderstatus END AS mark FROM orders)
    WHERE mark BETWEEN '' AND 'O'
    """
)
def pruned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds on a text partition that holds the empty text and nulls."""
    status = F.col("o_orderstatus")
    mark = F.when(status == "P", F.lit("")).when(status != "F", status)
    table = new_warehouse(spark, "marks").table(NAMESPACE, "orders")
    table.load(given(spark, sf_dir, "orders").select("o_orderkey", mark.alias("mark")), partition_by=["mark"])
    return table.read(between={"mark": ("", "O")})


@query("SELECT * FROM lineitem")
def restore_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = given(spark, sf_dir, "lineitem")
    return restore(changes_of(lineitem, NAMESPACE, "lineitem"), declared(spark, sf_dir, "lineitem"))


@query(
    """
    SELECT v.position, v.column_name, v.data_type, v.stored_type, v.primary_key, v.required, c.present
    FROM (VALUES
      (1, 'o_orderkey', 'int64', 'bigint', true, true),
      (2, 'o_custkey', 'int64', 'bigint', false, false),
      (3, 'o_orderstatus', 'string', 'string', false, false),
      (4, 'o_totalprice', 'float64', 'double', false, false),
      (5, 'o_orderdate', 'timestamp', 'timestamp_ntz', false, false),
      (6, 'o_orderpriority', 'string', 'string', false, false)
    ) v(position, column_name, data_type, stored_type, primary_key, required)
    JOIN (
      SELECT 1 AS position, count(o_orderkey) AS present FROM orders
      UNION ALL SELECT 2, count(o_custkey) FROM orders
      UNION ALL SELECT 3, count(o_orderstatus) FROM orders
      UNION ALL SELECT 4, count(o_totalprice) FROM orders
      UNION ALL SELECT 5, count(o_orderdate) FROM orders
      UNION ALL SELECT 6, count(o_orderpriority) FROM orders) c ON c.position = v.position
    """
)
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_warehouse(spark, "describe").table(NAMESPACE, "orders")
    table.register([f"{sf_dir}/orders.parquet"], declared(spark, sf_dir, "orders", ("o_orderkey",)))
    return describe_schema(table.read(), table.schema())


@query(
    """
    SELECT 'l_orderkey' AS column_name, 'long' AS type_name, 'int64' AS data_type, count(l_orderkey) AS present FROM lineitem
    UNION ALL SELECT 'l_returnflag', 'string', 'string', count(l_returnflag) FROM lineitem
    UNION ALL SELECT 'l_discount', 'double', 'float64', count(l_discount) FROM lineitem
    UNION ALL SELECT 'l_shipdate', 'timestamp', 'timestamp', count(l_shipdate) FROM lineitem
    UNION ALL SELECT 'price', 'decimal', 'any', count(l_extendedprice) FROM lineitem
    UNION ALL SELECT 'flags', 'array', 'any', count(*) FROM lineitem
    """
)
def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        "l_discount",
        "l_shipdate",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    cells = changes_of(rows, NAMESPACE, "lineitem").select(
        F.explode(F.arrays_zip(F.col("column_names"), F.col("column_values"))).alias("cell")
    )
    typed = cells.select(
        F.col("cell.column_names").alias("column_name"), value_type_name(F.col("cell.column_values")).alias("held")
    ).filter("held is not null")
    return typed.groupBy(
        "column_name",
        F.regexp_extract("held", "^([a-z]+)", 1).alias("type_name"),
        canonical_type(F.col("held")).alias("data_type"),
    ).agg(F.count(F.lit(1)).alias("present"))


@query(_COUNTS)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).list_tables(NAMESPACE).select("namespace", "table", "rows", "is_view")


@query(f"SELECT * FROM ({_COUNTS}) WHERE \"table\" IN ('orders', 'lineitem', 'documents')")
def include_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [f"{NAMESPACE}.{t}" for t in ("orders", "lineitem", "documents")]
    return (
        catalog(spark, sf_dir).list_tables(NAMESPACE, listed).select("namespace", "table", "rows", "is_view")
    )


def _orders_with_deletes(spark: SparkSession, sf_dir: str, name: str):
    table = new_warehouse(spark, name).table(NAMESPACE, "orders")
    table.load(given(spark, sf_dir, "orders"), load_id="all")
    table.delete_where("o_orderstatus = 'P'", "delete-p")
    return table


@query("SELECT 'orders' AS \"table\", count(*) AS rows FROM orders")
def estimate_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _orders_with_deletes(spark, sf_dir, "estimate")
    return one_row(spark, table="orders", rows=table.count(exact=False)).select("table", F.col("rows").cast("bigint"))


@query("SELECT 'orders' AS \"table\", count(*) AS rows FROM orders WHERE o_orderstatus <> 'P'")
def exact_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _orders_with_deletes(spark, sf_dir, "exact")
    return table.read().agg(F.count(F.lit(1)).alias("rows")).select(F.lit("orders").alias("table"), "rows")


@query(
    """
    SELECT 'orders' AS "table", true AS present, count(*) AS rows FROM orders
    UNION ALL SELECT 'part', false, count(*) FROM part
    UNION ALL SELECT 'nowhere', false, 0
    """
)
def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "exists")
    loaded = {}
    for name in ("orders", "part"):
        loaded[name] = warehouse.table(NAMESPACE, name).load(given(spark, sf_dir, name)).rows
    warehouse.table(NAMESPACE, "part").drop()
    return stack(
        [
            one_row(spark, table=n, present=warehouse.table_exists(NAMESPACE, n)).withColumn(
                "rows", F.lit(loaded.get(n, 0)).cast("bigint")
            )
            for n in ("orders", "part", "nowhere")
        ]
    )


@query(
    """
    SELECT page_id, array_to_string(parts[:len(parts) - 1], '.') AS namespace, parts[len(parts)] AS name,
           array_to_string(parts, '.') AS table_id, parts[1] AS one_part_name
    FROM (SELECT page_id, string_split(regexp_extract(url, '^https?://([^/?#]+)', 1), '.') AS parts FROM pages)
    """
)
def table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split(F.regexp_extract("url", "^https?://([^/?#]+)", 1), r"\.")
    ids = given(spark, sf_dir, "pages").select(
        "page_id", id_namespace(parts).alias("namespace"), id_name(parts).alias("name"), F.get(parts, F.lit(0)).alias("first")
    )
    one = F.array("first")
    return ids.select(
        "page_id",
        "namespace",
        "name",
        join_id(F.col("namespace"), F.col("name")).alias("table_id"),
        join_id(id_namespace(one), id_name(one)).alias("one_part_name"),
    )


@query("SELECT * FROM orders")
def read_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_warehouse(spark, "current").table(NAMESPACE, "orders")
    orders = given(spark, sf_dir, "orders")
    table.load(orders.filter("o_orderstatus = 'F'"), load_id="first")
    table.load(orders, load_id="second", mode="replace")
    return table.read()


_VERSIONS = (("F",), ("F", "O"), ("F", "O", "P"))


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS version, o_orderkey, o_orderstatus, o_totalprice FROM orders "
        f"WHERE o_orderstatus IN ({', '.join(repr(s) for s in statuses)})"
        for i, statuses in enumerate(_VERSIONS, 1)
    )
)
def read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = orders_by_status(spark, sf_dir).table(NAMESPACE, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return stack([table.read(columns, as_of=v).select(F.lit(v).alias("version"), *columns) for v in (1, 2, 3)])


@query(
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS added_in, o_orderkey, o_totalprice
    FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
    """
)
def read_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = orders_by_status(spark, sf_dir).table(NAMESPACE, "orders")
    columns = ["o_orderkey", "o_totalprice"]
    return stack(
        [table.read(columns, since=v - 1, as_of=v).select(F.lit(v).alias("added_in"), *columns) for v in (1, 2, 3)]
    )


@query(
    """
    SELECT 1::BIGINT AS seq, 'append' AS op, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, 'append', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 3, 'append', count(*) FROM orders WHERE o_orderstatus = 'P'
    """
)
def ledger_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions are listed; one that is not among them is refused."""
    table = orders_by_status(spark, sf_dir).table(NAMESPACE, "orders")
    for missing in (0, 4, "no such tag"):
        try:
            table.read(as_of=missing)
        except VersionNotFound:
            continue
        raise RuntimeError(f"version {missing!r} was read")
    return table.versions().select("seq", "op", "rows")


@query(
    "SELECT * FROM lineitem WHERE l_quantity >= 25 AND l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1997-01-01'"
)
def filtered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = (
        (F.col("l_quantity") >= 25)
        & (F.col("l_returnflag") == "R")
        & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    return registered(spark, sf_dir, "lineitem").read(where=condition)


@query("SELECT l_orderkey, l_extendedprice FROM lineitem")
def projected_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered(spark, sf_dir, "lineitem").read(["l_orderkey", "l_extendedprice"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, year(l_shipdate)::INTEGER - 1970 AS ship_year FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1998-06-30'
    """
)
def pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        lineitem_by_year(spark, sf_dir)
        .table(NAMESPACE, "lineitem")
        .read(
            ["l_orderkey", "l_linenumber", "l_shipdate"],
            between={"l_shipdate": ("1996-03-01", "1998-06-30")},
            partitions=True,
        )
    )
    return rows.withColumnRenamed("_p_l_shipdate_year", "ship_year")


@query("SELECT count(*) AS rows, true AS within_limit, true AS files_cover_rows FROM lineitem")
def batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = 10_240
    table = new_warehouse(spark, "batches").table(NAMESPACE, "lineitem")
    table.load(given(spark, sf_dir, "lineitem"), max_records_per_file=limit)
    return table.manifest().agg(
        F.sum("rows").alias("rows"),
        (F.max("rows") <= limit).alias("within_limit"),
        (F.count(F.lit(1)) * limit >= F.sum("rows")).alias("files_cover_rows"),
    )


@query("SELECT * FROM customer")
def relational_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path after a relational read; the given table stands in for the database table."""
    table = new_warehouse(spark, "relational").table("public", "customer")
    cols = [
        ColSchema("c_custkey", "int64", primary_key=True, required=True),
        ColSchema("c_name", "string"),
        ColSchema("c_nationkey", "int32"),
        ColSchema("c_acctbal", "float64"),
        ColSchema("c_mktsegment", "string"),
    ]
    table.load(given(spark, sf_dir, "customer"), cols)
    return table.read()


@query("SELECT conv_id || '-' || turn AS _id, conv_id, turn, role, text FROM conversations")
def document_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "documents")
    turns = given(spark, sf_dir, "conversations")
    whole = F.struct(F.concat_ws("-", "conv_id", "turn").alias("_id"), *turns.columns)
    turns.select(F.to_json(whole).alias("value")).write.text(path)
    table = new_warehouse(spark, "collection").table("db", "conversations")
    table.load(
        document_collection(spark, path),
        [ColSchema("_id", "string", primary_key=True, required=True), ColSchema("document", "string")],
    )
    fields = [ColSchema("conv_id", "int64"), ColSchema("turn", "int64"), ColSchema("role", "string"), ColSchema("text", "string")]
    stored = table.read().withColumnRenamed("_id", "_topic")
    return parse_messages(stored, fields, value="document").withColumnRenamed("_topic", "_id")


@query("SELECT event_id::INTEGER AS event_id, ts, user_id, event_type, value, props FROM events")
def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "messages")
    events = given(spark, sf_dir, "events")
    # ids are text in the messages
    texts = [F.col(c).cast("string").alias(c) for c in ("event_id", "ts")]
    body = F.struct(*texts, "user_id", "event_type", "value", "props")
    messages = events.select(F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"))
    quarter = land(messages, path)
    cols = [
        ColSchema("event_id", "int32", primary_key=True),
        ColSchema("ts", "timestamp"),
        ColSchema("user_id", "int64"),
        ColSchema("event_type", "string"),
        ColSchema("value", "float64"),
        ColSchema("props", "string"),
    ]
    warehouse = new_warehouse(spark, "topic")
    table = warehouse.table("streaming", "events")
    messages = message_files(spark, path, "events", files_per_batch=quarter)
    stream_table(
        parse_messages(messages, cols), table, "topic", scratch_dir(spark, "checkpoint"), drain=True
    ).awaitTermination()
    return table.read([c.name for c in cols]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


