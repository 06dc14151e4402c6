"""Tables with special content: deletes, added columns, histories, nested and odd values, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import (
    NAMESPACE,
    given,
    new_warehouse,
    registered,
    query,
    stack,
)
from tableload.functions.types import ColSchema, from_struct_type
from tableload.operators.verify import count_rows, reconcile
from tableload.plans.table import Table


def _loaded(spark: SparkSession, df: DataFrame, name: str, **options: object) -> Table:
    table = new_warehouse(spark, name).table(NAMESPACE, name)
    table.load(df, load_id="all", **options)
    return table


@query("SELECT * FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_quantity < 10)")
def read_with_position_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, given(spark, sf_dir, "lineitem"), "lineitem")
    table.delete_where("l_returnflag = 'R' and l_quantity < 10")
    return table.read()


@query("SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'")
def read_with_double_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, given(spark, sf_dir, "orders"), "orders")
    table.delete_where("o_orderstatus = 'P'")
    table.delete_where("o_orderpriority = '1-URGENT'")
    return table.read()


@query("SELECT p_partkey, p_name, CASE WHEN p_type <> 'ECONOMY' THEN p_brand END AS p_brand FROM part")
def read_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    table = new_warehouse(spark, "added").table(NAMESPACE, "part")
    table.load(part.filter("p_type = 'ECONOMY'").select("p_partkey", "p_name"), load_id="before")
    table.add_columns([ColSchema("p_brand", "string")])
    table.load(part.filter("p_type <> 'ECONOMY'"), load_id="after")
    return table.read()


@query(
    """
    SELECT * FROM orders
    WHERE o_orderstatus = 'P' OR (o_orderstatus IN ('F', 'O') AND o_totalprice < 100000)
    """
)
def read_after_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    table = new_warehouse(spark, "operations").table(NAMESPACE, "orders")
    table.load(orders.filter("o_orderstatus = 'F'"), load_id="f")
    table.load(orders.filter("o_orderstatus = 'O'"), load_id="o")
    table.delete_where("o_totalprice >= 100000")
    table.load(orders.filter("o_orderstatus = 'P'"), load_id="p")
    return table.read()


@query(
    """
    SELECT 'tag' AS ref, o_orderkey, o_orderpriority FROM orders
    UNION ALL SELECT 'branch', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT 'main', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'
    """
)
def read_named_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _loaded(spark, given(spark, sf_dir, "orders"), "orders")
    table.tag("complete")
    branch = table.branch("without_low")
    branch.delete_where("o_orderpriority = '5-LOW'")
    table.delete_where("o_orderpriority = '1-URGENT'")
    columns = ["o_orderkey", "o_orderpriority"]
    return stack(
        [
            table.read(columns, as_of="complete").select(F.lit("tag").alias("ref"), *columns),
            branch.read(columns).select(F.lit("branch").alias("ref"), *columns),
            table.read(columns).select(F.lit("main").alias("ref"), *columns),
        ]
    )


@query(
    """
    SELECT l_returnflag, count(*) AS rows,
           count(*) FILTER (l_returnflag = 'A') AS nans,
           count(*) FILTER (l_returnflag = 'R') AS nulls,
           l_returnflag = 'A' AS largest_is_nan
    FROM lineitem GROUP BY l_returnflag
    """
)
def nan_vs_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = given(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_returnflag") == "A", F.lit(float("nan")))
        .when(F.col("l_returnflag") != "R", F.col("l_quantity"))
        .alias("number"),
    )
    stored = _loaded(spark, numbers, "numbers").read()
    return stored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.isnan("number")).alias("nans"),
        F.count_if(F.col("number").isNull()).alias("nulls"),
        F.coalesce(F.isnan(F.max("number")), F.lit(False)).alias("largest_is_nan"),
    )


@query("SELECT * FROM orders")
def rewrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = registered(spark, sf_dir, "orders")
    return _loaded(spark, source.read(), "rewritten", mode="replace").read()


@query(
    """
    SELECT vec_id, label, (i - 1)::INTEGER AS position, embedding[i]::DOUBLE AS value
    FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    """
)
def explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = given(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.posexplode("embedding").alias("position", "value")
    )
    stored = _loaded(spark, exploded, "exploded").read()
    return stored.withColumn("value", F.col("value").cast("double"))


_ALL_TYPES = (
    "l_orderkey as long_col",
    "l_linenumber as int_col",
    "cast(l_linenumber as float) as float_col",
    "l_extendedprice as double_col",
    "cast(l_shipdate as date) as date_col",
    "cast(l_shipdate as timestamp) as timestamp_col",
    "l_returnflag as string_col",
    "l_quantity > 25 as boolean_col",
    "cast(l_linestatus as binary) as binary_col",
    "cast(l_linenumber as byte) as byte_col",
    "cast(l_discount as decimal(10,2)) as decimal_col",
    "cast(l_linenumber as short) as short_col",
    "map(l_orderkey, cast(l_discount as decimal(10,2))) as map_col",
    "array(l_orderkey, l_partkey) as array_col",
)


@query(
    """
    SELECT l_orderkey AS long_col, l_linenumber AS int_col, l_linenumber::DOUBLE AS float_col,
           l_extendedprice AS double_col, l_shipdate::DATE AS date_col, l_shipdate AS timestamp_col,
           l_returnflag AS string_col, l_quantity > 25 AS boolean_col, l_linestatus AS binary_text,
           l_linenumber AS byte_col, l_discount AS decimal_value, l_linenumber AS short_col,
           l_orderkey AS map_key, l_discount AS map_value, l_partkey AS array_last, 2 AS array_size,
           l_orderkey AS struct_array_first, l_discount AS struct_map_value
    FROM lineitem
    """
)
def all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "lineitem").selectExpr(*_ALL_TYPES)
    rows = rows.withColumn("struct_col", F.struct("map_col", "array_col"))
    stored = _loaded(spark, rows, "all_types", nested="native", partition_by=["int_col"]).read()
    return stored.select(
        "long_col",
        "int_col",
        F.col("float_col").cast("double").alias("float_col"),
        "double_col",
        "date_col",
        F.col("timestamp_col").cast("timestamp_ntz").alias("timestamp_col"),
        "string_col",
        "boolean_col",
        F.col("binary_col").cast("string").alias("binary_text"),
        "byte_col",
        F.col("decimal_col").cast("double").alias("decimal_value"),
        "short_col",
        F.get(F.map_keys("map_col"), F.lit(0)).alias("map_key"),
        F.get(F.map_values("map_col"), F.lit(0)).cast("double").alias("map_value"),
        F.try_element_at("array_col", F.lit(-1)).alias("array_last"),
        F.size("array_col").alias("array_size"),
        F.get("struct_col.array_col", F.lit(0)).alias("struct_array_first"),
        F.try_element_at("struct_col.map_col", F.col("long_col")).cast("double").alias("struct_map_value"),
    )


@query(
    """
    SELECT event_id, event_type IN ('error', 'click') AS list_is_null,
           CASE WHEN event_type = 'view' THEN 0 WHEN event_type NOT IN ('error', 'click') THEN 1 END AS list_size,
           event_type IN ('error', 'click') AS map_is_null,
           CASE WHEN event_type = 'view' THEN 0 WHEN event_type NOT IN ('error', 'click') THEN 1 END AS map_size,
           CASE WHEN event_type NOT IN ('error', 'click', 'view') THEN user_id END AS first_struct_user
    FROM events
    """
)
def empty_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    absent, empty = kind.isin("error", "click"), kind == "view"
    user = F.col("user_id")

    def filled_or_empty(filled, dtype: str):
        nothing = F.from_json(F.lit("{}" if dtype.startswith("map") else "[]"), dtype)
        return F.when(empty, nothing).when(~absent, filled)

    rows = given(spark, sf_dir, "events").select(
        "event_id",
        filled_or_empty(F.array(user), "array<bigint>").alias("col_list"),
        filled_or_empty(F.create_map(user.cast("string"), user), "map<string,bigint>").alias("col_map"),
        filled_or_empty(F.array(F.struct(user.alias("test"))), "array<struct<test:bigint>>").alias("col_structs"),
    )
    stored = _loaded(spark, rows, "collections", nested="native").read()
    return stored.select(
        "event_id",
        F.col("col_list").isNull().alias("list_is_null"),
        F.when(F.col("col_list").isNotNull(), F.size("col_list")).alias("list_size"),
        F.col("col_map").isNull().alias("map_is_null"),
        F.when(F.col("col_map").isNotNull(), F.size("col_map")).alias("map_size"),
        F.get("col_structs.test", F.lit(0)).alias("first_struct_user"),
    )


@query(
    """
    SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
           || '-' || substr(h, 21, 12) AS uuid_col, upper(hex(substr(h, 1, 25))) AS fixed_hex, 25 AS fixed_length
    FROM (SELECT doc_id, md5(text) AS h FROM documents)
    """
)
def uuid_and_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.md5("text")
    parts = [F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    rows = given(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("-", *parts).alias("uuid_col"), F.substring(h, 1, 25).cast("binary").alias("fixed_col")
    )
    stored = _loaded(spark, rows, "fixed").read()
    return stored.select(
        "doc_id", "uuid_col", F.hex("fixed_col").alias("fixed_hex"), F.octet_length("fixed_col").alias("fixed_length")
    )


@query('SELECT c_custkey AS "key.id", c_mktsegment AS "letter/abc", c_name AS "name with space" FROM customer')
def odd_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key.id"),
        F.col("c_mktsegment").alias("letter/abc"),
        F.col("c_name").alias("name with space"),
    )
    return _loaded(spark, rows, "odd").read()


@query(
    " UNION ALL ".join(
        f"SELECT 'sf' AS namespace, '{t}' AS \"table\", count(*) AS expected, 0::BIGINT AS actual, "
        f"-count(*) AS difference FROM {t}"
        for t in ("orders", "customer")
    )
)
def empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with a schema and no rows, against the rows their sources hold."""
    warehouse = new_warehouse(spark, "empty")
    sources, targets = [], []
    for name in ("orders", "customer"):
        source = given(spark, sf_dir, name)
        table = warehouse.table(NAMESPACE, name)
        table.ensure(from_struct_type(source.schema))
        sources.append(count_rows(source, NAMESPACE, name))
        targets.append(count_rows(table.read(), NAMESPACE, name))
    return reconcile(stack(sources), stack(targets))


def _partitions(spark: SparkSession, df: DataFrame, spec: str, column: str, measured: str) -> DataFrame:
    """Rows per partition value, read back from a table partitioned that way."""
    stored = _loaded(spark, df, "partitioned", partition_by=[spec]).read(partitions=True)
    return stored.groupBy(F.col(f"`{column}`").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(measured).alias("lowest"), F.max(measured).alias("highest")
    )


def _partition_sql(value: str, table: str, measured: str) -> str:
    return (
        f"SELECT {value} AS part, count(*) AS rows, min({measured}) AS lowest, max({measured}) AS highest "
        f"FROM {table} GROUP BY 1"
    )


@query(_partition_sql("event_type", "events", "event_id"))
def part_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(spark, given(spark, sf_dir, "events"), "event_type", "_p_event_type", "event_id")


@query(_partition_sql("(year(o_orderdate) - 1970)::INTEGER", "orders", "o_orderdate"))
def part_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(spark, given(spark, sf_dir, "orders"), "years(o_orderdate)", "_p_o_orderdate_year", "o_orderdate")


@query(_partition_sql("((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1)::INTEGER", "orders", "o_orderdate"))
def part_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(
        spark, given(spark, sf_dir, "orders"), "months(o_orderdate)", "_p_o_orderdate_month", "o_orderdate"
    )


@query(_partition_sql("date_diff('day', DATE '1970-01-01', ts::DATE)::INTEGER", "events", "ts"))
def part_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(spark, given(spark, sf_dir, "events"), "days(ts)", "_p_ts_day", "ts")


@query(_partition_sql("floor(epoch(ts) / 3600)::INTEGER", "events", "ts"))
def part_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(spark, given(spark, sf_dir, "events"), "hours(ts)", "_p_ts_hour", "ts")


@query(
    f"SELECT * FROM ({_partition_sql('substr(p_name, 1, 2)', 'part', 'p_name')}) "
    f"UNION ALL SELECT part::VARCHAR, rows, lowest::VARCHAR, highest::VARCHAR "
    f"FROM ({_partition_sql('p_size - p_size % 10', 'part', 'p_size')})"
)
def part_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    text = _partitions(spark, part, "truncate(2, p_name)", "_p_p_name_trunc", "p_name")
    whole = _partitions(spark, part, "truncate(10, p_size)", "_p_p_size_trunc", "p_size")
    return text.unionByName(whole.select(*[F.col(c).cast("string" if c != "rows" else "bigint").alias(c) for c in whole.columns]))


@query("SELECT count(*) AS rows, count(DISTINCT o_custkey) AS keys, true AS in_range, true AS one_bucket_per_key FROM orders")
def part_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket numbers are Spark's own; what is checked is that they are in range and one per key."""
    stored = _loaded(spark, given(spark, sf_dir, "orders"), "bucketed", partition_by=["bucket(16, o_custkey)"])
    per_key = (
        stored.read(partitions=True)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("_p_o_custkey_bucket").alias("low"),
            F.max("_p_o_custkey_bucket").alias("high"),
        )
    )
    return per_key.agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        ((F.min("low") >= 0) & (F.max("high") < 16)).alias("in_range"),
        F.bool_and(F.col("low") == F.col("high")).alias("one_bucket_per_key"),
    )
