"""Bulk loads, and their verification."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import (
    EVENT_SCHEMAS,
    NAMESPACE,
    declared,
    event_feed,
    given,
    landed_events,
    lineitem_in_parts,
    new_warehouse,
    query,
    registered,
    stack,
)
from tableload.functions.types import ColSchema, from_struct_type
from tableload.operators import verify
from tableload.operators.feed import control_events, table_to_changes
from tableload.operators.transform import Transform
from tableload.plans.warehouse import collect_parts as parts_of
from tableload.plans.warehouse import manifest
from tableload.session import scratch_dir
from tableload.sources.external import row_files
from tableload.streaming.append import stream_append, transfer


@query("""SELECT 'orders' AS "table", * FROM orders UNION ALL BY NAME SELECT 'nation' AS "table", * FROM nation""")
def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed feed of two tables, routed, converted, staged and published; then read back, all columns of both."""
    warehouse = new_warehouse(spark, "snapshot")
    names = ("nation", "orders")
    feed = stack([table_to_changes(given(spark, sf_dir, n), NAMESPACE, n) for n in names])
    schemas = {(NAMESPACE, n): declared(spark, sf_dir, n) for n in names}
    warehouse.load_feed(feed, schemas, "first")
    nation, orders = (warehouse.table(NAMESPACE, n).read().withColumn("table", F.lit(n)) for n in names)
    return orders.unionByName(nation, allowMissingColumns=True)


@query("SELECT 'created' AS first, 'kept' AS second, count(*) AS rows FROM part")
def ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    table = new_warehouse(spark, "ensure").table(NAMESPACE, "part")
    first = table.ensure(from_struct_type(part.schema))
    table.load(part)
    second = table.ensure(from_struct_type(part.schema))
    return table.read().agg(
        F.lit("created" if first else "kept").alias("first"),
        F.lit("created" if second else "kept").alias("second"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("SELECT * FROM lineitem")
def write_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_in_parts(spark, sf_dir).table(NAMESPACE, "lineitem").read()


@query("SELECT (l_orderkey % 4)::VARCHAR AS load_part, count(*) AS rows FROM lineitem GROUP BY 1")
def part_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = lineitem_in_parts(spark, sf_dir).table(NAMESPACE, "lineitem").manifest()
    return files.groupBy("load_part").agg(F.sum("rows").alias("rows"))


@query(
    """
    SELECT event_type AS "table", count(DISTINCT user_id % 4) AS parts, count(*) AS rows FROM events GROUP BY event_type
    """
)
def collect_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts gathered per table: a load of five tables keeps their files apart."""
    warehouse = new_warehouse(spark, "collect")
    warehouse.load_feed(event_feed(given(spark, sf_dir, "events")), EVENT_SCHEMAS, "all")
    return parts_of(manifest(warehouse, EVENT_SCHEMAS)).select("table", "parts", "rows")


@query("SELECT * FROM customer")
def add_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing files become a table; adding them again is refused."""
    table = new_warehouse(spark, "files").table(NAMESPACE, "customer")
    path = f"{sf_dir}/customer.parquet"
    table.register([path], load_id="first")
    try:
        table.register([path], load_id="again")
    except ValueError:
        return table.read()
    raise RuntimeError("files were added twice")


@query("SELECT 'snapshot' AS purpose, o_orderstatus AS status, count(*) AS rows FROM orders GROUP BY o_orderstatus")
def load_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per status, which its properties name."""
    orders = given(spark, sf_dir, "orders")
    table = new_warehouse(spark, "properties").table(NAMESPACE, "orders")
    for (status,) in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect():
        table.load(orders.filter(F.col("o_orderstatus").eqNullSafe(status)), props={"purpose": "snapshot", "status": status})
    return table.versions().filter("op = 'append'").select(
        F.try_element_at("props", F.lit("purpose")).alias("purpose"),
        F.try_element_at("props", F.lit("status")).alias("status"),
        "rows",
    )


@query("SELECT 'kept' AS \"table\", count(*) AS rows FROM customer UNION ALL SELECT 'remade', count(*) FROM supplier")
def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped tables are gone, dropping an absent one is no error, a later load begins a new life."""
    warehouse = new_warehouse(spark, "drop")
    for name in ("kept", "gone", "remade"):
        warehouse.table(NAMESPACE, name).load(given(spark, sf_dir, "customer"))
    for name in ("gone", "remade", "never"):
        warehouse.table(NAMESPACE, name).drop()
    warehouse.table(NAMESPACE, "remade").load(given(spark, sf_dir, "supplier"))
    return warehouse.list_tables(NAMESPACE).select("table", "rows")


@query("SELECT s_suppkey, s_name FROM supplier")
def truncate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation hides the rows, those before it in the feed too, and takes the event's schema; an absent table is not made."""
    warehouse = new_warehouse(spark, "truncate")
    supplier = given(spark, sf_dir, "supplier")
    warehouse.table(NAMESPACE, "supplier").load(given(spark, sf_dir, "customer"))
    narrow = from_struct_type(supplier.select("s_suppkey", "s_name").schema)
    events = spark.createDataFrame([("supplier",), ("never",)], "name string")
    control = control_events(events, F.lit("truncate"), F.lit(NAMESPACE), F.col("name"), F.lit(1_000_000_000_000))
    old = table_to_changes(supplier.withColumn("s_name", F.lit("old")), NAMESPACE, "supplier", lsn=F.col("s_suppkey"))
    rows = table_to_changes(supplier, NAMESPACE, "supplier", lsn=F.col("s_suppkey") + F.lit(1_000_000_000_001))
    schemas = {(NAMESPACE, "supplier"): narrow, (NAMESPACE, "never"): narrow}
    warehouse.load_feed(stack([rows, control, old]), schemas, "after")
    if warehouse.table_exists(NAMESPACE, "never"):
        raise RuntimeError("an absent table was created")
    return warehouse.table(NAMESPACE, "supplier").read()


@query(
    """
    SELECT 'orders' AS "table", o_orderkey AS key FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 3 * 2 FROM orders)
    UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_custkey > (SELECT max(c_custkey) // 2 FROM customer)
    UNION ALL SELECT 'part', p_partkey FROM part
    """
)
def ordered_clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several clean-up events amid the rows of one feed: of each table only the rows after its last one stay.

    ``orders`` is truncated at a third and two thirds of its keys, ``customer`` truncated at a quarter and dropped at half, ``part``
    cleaned up by an event without a position.
    """
    warehouse = new_warehouse(spark, "ordered")
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    frames = {name: given(spark, sf_dir, name) for name in keys}
    for name, df in frames.items():
        warehouse.table(NAMESPACE, name).load(df)

    def event(name: str, kind: str, position: str | None) -> DataFrame:
        top = frames[name].agg(F.max(keys[name]).alias("top"))
        lsn = F.lit(None) if position is None else F.expr(position)
        return control_events(top, F.lit(kind), F.lit(NAMESPACE), F.lit(name), lsn)

    feed = [table_to_changes(df, NAMESPACE, name, lsn=F.col(keys[name])) for name, df in frames.items()]
    feed += [event("orders", "truncate", "top div 3"), event("orders", "truncate", "top div 3 * 2")]
    feed += [event("customer", "truncate", "top div 4"), event("customer", "drop", "top div 2"), event("part", "truncate", None)]
    warehouse.load_feed(stack(feed), {(NAMESPACE, n): declared(spark, sf_dir, n) for n in keys}, "ordered")
    return stack([warehouse.table(NAMESPACE, n).read().select(F.lit(n).alias("table"), F.col(k).cast("bigint").alias("key")) for n, k in keys.items()])


@query(
    """
    SELECT *, (l_orderkey % 4)::VARCHAR AS load_part, 5 AS calls, 1 AS loads FROM lineitem
    """
)
def completion_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four workers stage their parts, in any order; the last done event publishes them, a repeated call changes nothing."""
    warehouse = new_warehouse(spark, "barrier")
    lineitem, key = given(spark, sf_dir, "lineitem"), (NAMESPACE, "lineitem")
    schemas = {key: declared(spark, sf_dir, "lineitem")}
    part = F.col("l_orderkey") % 4
    one = spark.range(1)
    names = [F.lit(n) for n in key]
    all_done = control_events(one, F.lit("done_sharded"), *names, parts=F.array(*[F.lit(str(i)) for i in range(4)]))

    def share(i: int) -> DataFrame:
        rows = table_to_changes(lineitem.filter(part == i), *key, load_part=part)
        return rows.unionByName(control_events(one, F.lit("done_table"), *names, load_part=F.lit(str(i))))

    calls = [share(2), all_done, share(0), share(3), share(1)]
    for i, feed in enumerate([*calls, share(3)]):
        published = warehouse.stage_feed(feed, schemas, "sharded")
        if bool(published) != (i >= 4) or i < 4 and warehouse.table_exists(*key) and warehouse.table(*key).count():
            raise RuntimeError(f"call {i} published {len(published)} tables")
    table = warehouse.table(*key)
    loads = table.versions().filter("op = 'append'").count()
    parts = table.manifest().select("load_part").distinct().count()
    if parts != 4:
        raise RuntimeError(f"{parts} parts")
    return table.read().select("*", part.cast("string").alias("load_part"), F.lit(len(calls)).alias("calls"), F.lit(loads).alias("loads"))


FLATTEN = """
    SELECT event_id, get_json_object(document, '$.kind') AS kind, cast(get_json_object(document, '$.user.id') AS bigint) AS user_id,
           cast(get_json_object(document, '$.user.value') AS double) AS value, upper(substr(get_json_object(document, '$.kind'), 1, 3)) AS code
    FROM {source} WHERE document IS NOT NULL
"""
FLATTENED = "SELECT event_id, event_type AS kind, user_id, value, upper(left(event_type, 3)) AS code FROM events"


def event_documents(events: DataFrame) -> DataFrame:
    """Events as documents of a collection: an id and one JSON text."""
    user = F.struct(F.col("user_id").alias("id"), "value")
    return events.select("event_id", F.to_json(F.struct(F.col("event_type").alias("kind"), user.alias("user"))).alias("document"))


DOCUMENTS = [ColSchema("event_id", "int64", primary_key=True, required=True), ColSchema("document", "string")]


@query(FLATTENED)
def transform_in_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are flattened by a SELECT on their way into the table, whose schema is the SELECT's; other tables pass unchanged."""
    warehouse = new_warehouse(spark, "flatten")
    feed = stack(
        [
            table_to_changes(event_documents(given(spark, sf_dir, "events")), "shop", "documents"),
            table_to_changes(given(spark, sf_dir, "region"), "shop", "region"),
        ]
    )
    schemas = {("shop", "documents"): DOCUMENTS, ("shop", "region"): declared(spark, sf_dir, "region")}
    flat = Transform(FLATTEN, ("shop.documents",), ("event_id",), into=("shop", "flat"))
    warehouse.load_feed(feed, schemas, "flatten", transforms=[flat])
    if warehouse.table("shop", "region").columns() != schemas["shop", "region"] or warehouse.table_exists("shop", "documents"):
        raise RuntimeError("a table that the transform is not for was changed")
    if warehouse.table("shop", "flat").identifier_columns() != ["event_id"]:
        raise RuntimeError("the keys of the result are not declared")
    return warehouse.table("shop", "flat").read()


@query(FLATTENED)
def transform_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents flattened batch by batch, by an appending stream."""
    path, quarter = landed_events(spark, sf_dir)
    warehouse = new_warehouse(spark, "flatten-stream")
    arriving = row_files(spark, path, given(spark, sf_dir, "events").schema, quarter)
    feed = table_to_changes(event_documents(arriving), "shop", "documents")
    flat = Transform(FLATTEN, ("shop.documents",), ("event_id",))
    stream_append(
        feed, warehouse, {("shop", "documents"): DOCUMENTS}, "flatten", scratch_dir(spark, "checkpoint"), drain=True, transforms=[flat]
    ).awaitTermination()
    return warehouse.table("shop", "documents").read()


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    table = new_warehouse(spark, "replace").table(NAMESPACE, "orders")
    table.load(orders, load_id="old")
    table.load(orders.filter("o_orderstatus <> 'F'"), load_id="new", mode="replace")
    return table.read()


@query("SELECT *, (l_orderkey % 8)::VARCHAR AS load_part, count(*) OVER (PARTITION BY l_orderkey % 8) AS part_rows FROM lineitem")
def sharded_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight workers stage their parts of one load, which is published once; nothing is seen before that."""
    lineitem = given(spark, sf_dir, "lineitem")
    table = new_warehouse(spark, "shards").table(NAMESPACE, "lineitem")
    table.ensure(declared(spark, sf_dir, "lineitem"))
    shard = F.pmod("l_orderkey", F.lit(8))
    parts = [str(i) for i in range(8)]
    stage = inheritable_thread_target(spark)(lambda part: table.stage_part(lineitem.filter(shard == int(part)), "sharded", part))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(stage, parts))
    if table.count():
        raise RuntimeError("staged rows are seen")
    table.publish_parts("sharded", parts)
    if table.count(exact=False) != table.count():
        raise RuntimeError("the estimate is not the exact count")
    rows = table.read().withColumn("load_part", shard.cast("string"))
    counts = table.manifest().groupBy("load_part").agg(F.sum("rows").alias("part_rows"))
    return rows.join(F.broadcast(counts), "load_part")


@query("SELECT 0::BIGINT AS empty_rows, 2 AS loads, count(*) AS rows FROM region")
def empty_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = given(spark, sf_dir, "region")
    table = new_warehouse(spark, "empty_load").table(NAMESPACE, "region")
    table.load(region, load_id="full")
    empty = table.load(region.filter(F.col("r_regionkey").isNull()), load_id="empty")
    return table.read().agg(
        F.lit(empty.rows).cast("bigint").alias("empty_rows"),
        F.lit(table.versions().count()).cast("int").alias("loads"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    """
    SELECT 'snapshot' AS source, 'loaded' AS outcome, count(*) AS rows FROM events
    UNION ALL SELECT 'append_stream', 'loaded', count(*) FROM events
    UNION ALL SELECT 'changes', 'refused', 0
    """
)
def choose_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame is bulk-loaded, a stream is appended, any other kind of transfer is refused."""
    path, quarter = landed_events(spark, sf_dir)
    events = given(spark, sf_dir, "events")
    bulk, live, none = (new_warehouse(spark, n) for n in ("bulk", "live", "none"))
    transfer(event_feed(events), bulk, EVENT_SCHEMAS, "bulk")
    stream = event_feed(row_files(spark, path, events.schema, quarter))
    transfer(stream, live, EVENT_SCHEMAS, "live", scratch_dir(spark, "checkpoint"), drain=True).awaitTermination()
    try:
        transfer(event_feed(events), none, EVENT_SCHEMAS, "changes", mode="snapshot_and_changes")
        outcome = "loaded"
    except ValueError:
        outcome = "refused"
    results = [("snapshot", "loaded", bulk), ("append_stream", "loaded", live), ("changes", outcome, none)]
    return stack(
        [
            w.list_tables().agg(
                F.lit(source).alias("source"),
                F.lit(text).alias("outcome"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            )
            for source, text, w in results
        ]
    )


@query(
    " UNION ALL ".join(
        f"SELECT 'sf' AS namespace, '{t}' AS \"table\", {e} AS expected, {a} AS actual, ({a} - {e})::BIGINT AS difference FROM {t}"
        for t, e, a in (
            ("orders", "count(*)", "count(*) FILTER (o_orderstatus <> 'F')"),
            ("customer", "count(*)", "0::BIGINT"),
            ("supplier", "0::BIGINT", "count(*)"),
            ("nation", "count(*)", "count(*)"),
        )
    )
)
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse that lacks rows of one table, lacks another, and holds one that has no source."""
    warehouse = new_warehouse(spark, "reconcile")
    loaded = {
        "orders": given(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'"),
        "supplier": given(spark, sf_dir, "supplier"),
        "nation": given(spark, sf_dir, "nation"),
    }
    for name, df in loaded.items():
        warehouse.table(NAMESPACE, name).load(df)
    expected = [verify.count_rows(given(spark, sf_dir, n), NAMESPACE, n) for n in ("orders", "customer", "nation")]
    actual = [verify.count_rows(warehouse.table(NAMESPACE, n).read(), NAMESPACE, n) for n in loaded]
    return verify.reconcile(stack(expected), stack(actual))


@query(
    """
    SELECT lang, count(*) AS rows, sum(8 + strlen(text) + strlen(lang) + strlen(source) + 8)::BIGINT AS bytes
    FROM documents GROUP BY lang
    """
)
def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.load_stats(registered(spark, sf_dir, "documents").read(), ["lang"])


@query(
    """
    SELECT 'copy' AS compared, true AS same_schema, true AS same_rows, 0::BIGINT AS missing, 0::BIGINT AS extra
    UNION ALL SELECT 'changed', true, false, count(*), count(*) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'other type', false, false, count(*), count(*) FROM orders
    UNION ALL SELECT 'shifted nulls', true, false, count(*), count(*) FROM orders
    UNION ALL SELECT 'empty and null', true, false, count(*), count(*) FROM orders
    """
)
def canon_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    table = new_warehouse(spark, "canon").table(NAMESPACE, "orders")
    table.load(orders)
    changed = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    )
    other = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("float"))
    key, none = F.col("o_custkey"), F.lit(None).cast("bigint")
    left, right = (orders.select(a.alias("a"), b.alias("b")) for a, b in ((key, none), (none, key)))
    some, absent = (orders.select("o_orderkey", v.alias("v")) for v in (F.array().cast("array<int>"), F.lit(None).cast("array<int>")))
    pairs = {
        "copy": (orders, table.read()),
        "changed": (changed, table.read()),
        "other type": (other, table.read()),
        "shifted nulls": (left, right),
        "empty and null": (some, absent),
    }
    return stack([verify.canon_compare(*pair).withColumn("compared", F.lit(label)) for label, pair in pairs.items()])


@query(
    """
    SELECT kind, true AS refused, count(*) FILTER (event_type = 'error') AS refused_rows, 0::BIGINT AS loaded_rows
    FROM events, (VALUES ('update'), ('upsert')) k(kind) GROUP BY kind
    """
)
def append_only_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with updates, or with rows of an unknown kind, is refused as a whole."""
    results = []
    for kind in ("update", "upsert"):
        feed = event_feed(given(spark, sf_dir, "events"))
        feed = feed.withColumn("kind", F.when(F.col("table") == "error", F.lit(kind)).otherwise(F.col("kind")))
        warehouse = new_warehouse(spark, f"guard-{kind}")
        try:
            warehouse.append_batch(feed, EVENT_SCHEMAS, "batch-0")
            refused = False
        except ValueError:
            refused = True
        loaded = sum(warehouse.table(*k).count(exact=False) for k in EVENT_SCHEMAS if warehouse.table_exists(*k))
        results.append(
            feed.agg(
                F.lit(kind).alias("kind"),
                F.lit(refused).alias("refused"),
                F.count_if(F.col("kind") == kind).alias("refused_rows"),
                F.lit(loaded).cast("bigint").alias("loaded_rows"),
            )
        )
    return stack(results)


@query("SELECT * FROM supplier")
def retried_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulk load that cleans up its table first is run twice under one id: the second run changes nothing."""
    warehouse = new_warehouse(spark, "retried")
    supplier = given(spark, sf_dir, "supplier")
    warehouse.table(NAMESPACE, "supplier").load(supplier.withColumn("s_name", F.lit("old")))
    control = control_events(spark.range(1), F.lit("truncate"), F.lit(NAMESPACE), F.lit("supplier"))
    feed = control.unionByName(table_to_changes(supplier, NAMESPACE, "supplier"))
    for _ in range(2):
        warehouse.load_feed(feed, {(NAMESPACE, "supplier"): declared(spark, sf_dir, "supplier")}, "nightly")
    return warehouse.table(NAMESPACE, "supplier").read()


@query("SELECT * FROM customer")
def repeated_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second transfer under a name takes the source anew."""
    warehouse = new_warehouse(spark, "repeated")
    customer = given(spark, sf_dir, "customer")
    schemas = {(NAMESPACE, "customer"): declared(spark, sf_dir, "customer")}
    for rows in (customer.withColumn("c_acctbal", F.lit(0.0)), customer):
        transfer(table_to_changes(rows, NAMESPACE, "customer"), warehouse, schemas, "nightly")
    return warehouse.table(NAMESPACE, "customer").read()
