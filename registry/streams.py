"""Append-only streams: events that land as files, appended batch by batch."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import (
    EVENT_COLUMNS,
    EVENT_SCHEMAS,
    NAMESPACE,
    event_feed,
    given,
    land,
    landed_events,
    new_warehouse,
    query,
    stack,
)
from tableload.functions.types import ColSchema
from tableload.operators.feed import control_events
from tableload.plans.table import Table
from tableload.plans.warehouse import Warehouse, manifest
from tableload.session import remove_folder, scratch_dir
from tableload.sources.external import row_files
from tableload.streaming.append import commit_interval, drain_and_stop, stream_append, stream_messages, stream_table


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, quarter = landed_events(spark, sf_dir)
    return row_files(spark, path, given(spark, sf_dir, "events").schema, files_per_batch=quarter)


def _one_table(spark: SparkSession, sf_dir: str, name: str):
    """A table that has taken in the whole stream, in four batches."""
    table = new_warehouse(spark, name).table(NAMESPACE, "events")
    stream_table(_arriving(spark, sf_dir), table, name, scratch_dir(spark, "checkpoint"), drain=True).awaitTermination()
    return table


def _fan_out(spark: SparkSession, sf_dir: str, name: str, **options: object) -> Warehouse:
    """A warehouse that has taken in the stream as a feed of five tables."""
    warehouse = new_warehouse(spark, name)
    stream_append(
        event_feed(_arriving(spark, sf_dir)), warehouse, EVENT_SCHEMAS, name, scratch_dir(spark, "checkpoint"),
        drain=True, **options,
    ).awaitTermination()
    return warehouse


@query("SELECT * FROM events", name="stream_append")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_table(spark, sf_dir, "append").read()


@query("SELECT '1 minute' AS unset, '1 minute' AS zero, '500 milliseconds' AS given, count(*) AS rows FROM events")
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running stream with a commit interval, closed once it has caught up."""
    table = new_warehouse(spark, "interval").table(NAMESPACE, "events")
    running = stream_table(_arriving(spark, sf_dir), table, "interval", scratch_dir(spark, "checkpoint"), interval=0.5)
    drain_and_stop(running)
    return table.read().agg(
        F.lit(commit_interval(None)).alias("unset"),
        F.lit(commit_interval(0)).alias("zero"),
        F.lit(commit_interval(0.5)).alias("given"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("SELECT event_type AS \"table\", event_id, ts, user_id, value, props FROM events WHERE event_type <> 'error'")
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, several tables, each made when its first rows arrive; control events are ignored."""
    warehouse = new_warehouse(spark, "fanout")
    arriving = _arriving(spark, sf_dir)
    rows = event_feed(arriving.filter("event_type <> 'error'"))
    control = control_events(arriving.filter("event_type = 'error'"), F.lit("drop"), F.lit("shop"), F.lit("click"))
    stream_append(
        rows.unionByName(control), warehouse, EVENT_SCHEMAS, "fanout", scratch_dir(spark, "checkpoint"), drain=True
    ).awaitTermination()
    columns = ["event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value", "props"]
    return stack(
        [
            warehouse.table(*key).read().select(F.lit(key[1]).alias("table"), *columns)
            for key in EVENT_SCHEMAS
            if key[1] != "error"
        ]
    )


@query("SELECT event_type AS \"table\", (user_id % 4)::VARCHAR AS load_part, count(*) AS rows FROM events GROUP BY ALL")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows gathered per table over all parts and batches."""
    warehouse = _fan_out(spark, sf_dir, "pending")
    return (
        manifest(warehouse, EVENT_SCHEMAS).groupBy("table", "load_part").agg(F.sum("rows").alias("rows"))
    )


@query("SELECT event_type AS \"table\", true AS each_batch_once, count(*) AS rows FROM events GROUP BY event_type")
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is published per table, on its own."""
    warehouse = _fan_out(spark, sf_dir, "publish", default_namespace="streaming")
    return stack(
        [
            warehouse.table(*key)
            .versions()
            .filter("op = 'append'")
            .agg(
                F.lit(key[1]).alias("table"),
                (F.count_distinct("load_id") == F.count(F.lit(1))).alias("each_batch_once"),
                F.sum("rows").alias("rows"),
            )
            for key in EVENT_SCHEMAS
        ]
    )


@query("SELECT count(*) AS rows, count(DISTINCT event_id) AS ids, 0::BIGINT AS loads_added FROM events")
def stream_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run from the same checkpoint finds nothing left to publish."""
    table = new_warehouse(spark, "again").table(NAMESPACE, "events")
    checkpoint = scratch_dir(spark, "checkpoint")
    loads = []
    for _ in range(2):
        stream_table(_arriving(spark, sf_dir), table, "again", checkpoint, drain=True).awaitTermination()
        loads.append(len(table.entries()))
    return table.read().agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("event_id").alias("ids"),
        F.lit(loads[1] - loads[0]).cast("bigint").alias("loads_added"),
    )


@query("SELECT * FROM events")
def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing a running stream publishes all that has arrived."""
    table = new_warehouse(spark, "drain").table(NAMESPACE, "events")
    running = stream_table(_arriving(spark, sf_dir), table, "drain", scratch_dir(spark, "checkpoint"), interval=1)
    drain_and_stop(running)
    return table.read()


@query("SELECT * FROM events")
def stream_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream dies after publishing its last batch and before noting it: the batch is replayed, and skipped by its id."""
    table = new_warehouse(spark, "recover").table(NAMESPACE, "events")
    checkpoint = scratch_dir(spark, "checkpoint")
    for turn in range(2):
        stream_table(_arriving(spark, sf_dir), table, "recover", checkpoint, drain=True).awaitTermination()
        if turn == 0:
            remove_folder(spark, f"{checkpoint}/commits/{len(table.entries()) - 1}")
    return table.read()


@query("SELECT event_type AS \"table\", count(*) AS rows, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run fails while one table of a batch is written; the restart publishes only what is missing."""
    warehouse = new_warehouse(spark, "once")
    checkpoint = scratch_dir(spark, "checkpoint")
    # no row has a value in this column, so that the load of one table fails and the others may be published
    broken = EVENT_SCHEMAS | {("shop", "view"): [*EVENT_COLUMNS, ColSchema("absent", "string", required=True)]}
    failed = False
    try:
        stream_append(
            event_feed(_arriving(spark, sf_dir)), warehouse, broken, "once", checkpoint, drain=True
        ).awaitTermination()
    except StreamingQueryException:
        failed = True
    if not failed:
        raise RuntimeError("the first run should have stopped")
    stream_append(
        event_feed(_arriving(spark, sf_dir)), warehouse, EVENT_SCHEMAS, "once", checkpoint, drain=True
    ).awaitTermination()
    return stack(
        [
            warehouse.table(*key)
            .read()
            .agg(
                F.lit(key[1]).alias("table"),
                F.count(F.lit(1)).alias("rows"),
                F.count_distinct("event_id").alias("ids"),
            )
            for key in EVENT_SCHEMAS
        ]
    )


@query(
    """
    SELECT event_type AS "table", count(*) AS rows, sum(8 + 8 + 8 + strlen(event_type) + 8 + strlen(props))::BIGINT AS bytes, true AS timed
    FROM events GROUP BY event_type
    """
)
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of every batch, as noted while it was written, add up to the tables."""
    warehouse = _fan_out(spark, sf_dir, "metrics")
    return stack(
        [
            warehouse.table(*key).metrics().agg(
                F.lit(key[1]).alias("table"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                F.bool_and(F.col("millis") > 0).alias("timed"),
            )
            for key in EVENT_SCHEMAS
        ]
    )


@query(
    """
    SELECT event_id AS _offset, CASE event_type WHEN 'error' THEN 'no JSON object' WHEN 'view' THEN 'value: no float64' WHEN 'signup' THEN 'id: missing' END AS reason,
           CASE WHEN event_type NOT IN ('error', 'view', 'signup') THEN value END AS value
    FROM events
    """
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good messages and bad ones part ways in each batch; the stream dies between the two loads of a batch, and goes on."""
    path = scratch_dir(spark, "mixed-messages")
    message = """
        case event_type when 'error' then concat('{"id": "', event_id, '", "level"')
        when 'view' then concat('{"id": "', event_id, '", "value": "v', value, '"}')
        when 'signup' then concat('{"id": null, "value": ', value, '}')
        else concat('{"id": "', event_id, '", "value": ', value, '}') end as value
    """
    quarter = land(given(spark, sf_dir, "events").selectExpr("event_id as _offset", message), path)
    cols = [ColSchema("id", "int64", required=True), ColSchema("value", "float64")]
    warehouse, checkpoint = new_warehouse(spark, "quarantine"), scratch_dir(spark, "checkpoint")
    good, bad = warehouse.table("topic", "events"), warehouse.table("topic", "events_rejected")
    schema = spark.read.parquet(path).schema

    def run(rejects: Table) -> None:
        messages = row_files(spark, path, schema, files_per_batch=quarter)
        stream_messages(messages, good, rejects, cols, "mixed", checkpoint, drain=True).awaitTermination()

    class Dying(Table):
        def load(self, *args: object, **options: object):
            raise RuntimeError("the stream dies before the rejected messages are loaded")

    try:
        run(Dying(spark, warehouse.root, "topic", "events_rejected"))
        raise ValueError("the first run should have stopped")
    except StreamingQueryException:
        run(bad)
    loaded = good.read().select(F.col("id").alias("_offset"), F.lit(None).cast("string").alias("reason"), "value")
    return loaded.unionByName(bad.read().select("_offset", "reason", F.lit(None).cast("double").alias("value")))
