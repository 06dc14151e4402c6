"""Registration of queries with their SQL, and the data they share."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableload.functions.types import ColSchema, from_struct_type, with_keys
from tableload.operators.feed import table_to_changes
from tableload.plans.table import Table
from tableload.plans.warehouse import Warehouse
from tableload.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The given tables.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

NAMESPACE = "sf"
STATUSES = ("F", "O", "P")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

_shared: dict[tuple, object] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_warehouse(spark: SparkSession, name: str) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, name))


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Data that several queries only read, made once per Spark application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def one_row(spark: SparkSession, **values: object) -> DataFrame:
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def registered(spark: SparkSession, sf_dir: str, name: str) -> Table:
    """A given table registered in place: no data is copied."""

    def build() -> Table:
        table = new_warehouse(spark, "registered").table(NAMESPACE, name)
        table.register([f"{sf_dir}/{name}.parquet"])
        return table

    return shared(spark, sf_dir, f"registered {name}", build)


def catalog(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Every given table registered in place, in one warehouse."""

    def build() -> Warehouse:
        warehouse = new_warehouse(spark, "catalog")
        add = inheritable_thread_target(spark)(
            lambda name: warehouse.table(NAMESPACE, name).register([f"{sf_dir}/{name}.parquet"])
        )
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(add, TABLES))
        return warehouse

    return shared(spark, sf_dir, "catalog", build)


def orders_by_status(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Orders in three loads, one per status: versions 1 to 3."""

    def build() -> Warehouse:
        warehouse = new_warehouse(spark, "orders")
        orders = given(spark, sf_dir, "orders")
        table = warehouse.table(NAMESPACE, "orders")
        for status in STATUSES:
            table.load(orders.filter(F.col("o_orderstatus") == status), load_id=f"status-{status}")
        return warehouse

    return shared(spark, sf_dir, "orders_by_status", build)


def lineitem_by_year(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Lineitem partitioned by year of shipping."""

    def build() -> Warehouse:
        warehouse = new_warehouse(spark, "lineitem")
        warehouse.table(NAMESPACE, "lineitem").load(
            given(spark, sf_dir, "lineitem"), load_id="all", partition_by=["years(l_shipdate)"]
        )
        return warehouse

    return shared(spark, sf_dir, "lineitem_by_year", build)


def lineitem_in_parts(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Lineitem loaded in four parts; a part is a label of the row, not a shuffle key."""

    def build() -> Warehouse:
        warehouse = new_warehouse(spark, "parts")
        warehouse.table(NAMESPACE, "lineitem").load(
            given(spark, sf_dir, "lineitem"), load_id="all", load_part=F.col("l_orderkey") % 4
        )
        return warehouse

    return shared(spark, sf_dir, "lineitem_in_parts", build)


EVENT_COLUMNS = [
    ColSchema("event_id", "int64", primary_key=True, required=True),
    ColSchema("ts", "timestamp"),
    ColSchema("user_id", "int64"),
    ColSchema("event_type", "string"),
    ColSchema("value", "float64"),
    ColSchema("props", "string"),
]
EVENT_SCHEMAS = {("shop", kind): EVENT_COLUMNS for kind in EVENT_TYPES}

BATCHES = 4


def land(df: DataFrame, path: str) -> int:
    """Write rows as files for a stream to find; gives the number of files that makes four batches.

    Input of many files keeps its partitions; only a table of very few files is split up, by a shuffle.
    """
    if len(df.inputFiles()) < BATCHES:
        df = df.repartition(max(BATCHES, df.sparkSession.sparkContext.defaultParallelism))
    df.write.parquet(path)
    return -(-len(df.sparkSession.read.parquet(path).inputFiles()) // BATCHES)


def landed_events(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Events as they would land for a stream, and how many of the files make a quarter of them."""

    def build() -> tuple[str, int]:
        path = scratch_dir(spark, "landed-events")
        return path, land(given(spark, sf_dir, "events"), path)

    return shared(spark, sf_dir, "landed_events", build)


def event_feed(events: DataFrame) -> DataFrame:
    """Events as a change feed, one table per event type."""
    return table_to_changes(
        events, "shop", F.col("event_type"), lsn=F.col("event_id"), load_part=F.col("user_id") % 4
    )


def declared(spark: SparkSession, sf_dir: str, table: str, keys: tuple[str, ...] = ()) -> list[ColSchema]:
    return with_keys(from_struct_type(given(spark, sf_dir, table).schema), keys)
