"""Append-only streams into tables: one load per micro-batch and table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tableload.functions.types import ColSchema
from tableload.operators.messages import DEDUPE_KEYS, REJECTED, quarantined
from tableload.operators.transform import Transform
from tableload.plans.table import Table
from tableload.plans.warehouse import Schemas, Warehouse

DEFAULT_INTERVAL = "1 minute"


def commit_interval(interval: str | float | None) -> str:
    """Trigger interval: one minute unless a positive number of seconds or a Spark interval is given."""
    if interval is None:
        return DEFAULT_INTERVAL
    if isinstance(interval, (int, float)):
        return f"{int(interval * 1000)} milliseconds" if interval > 0 else DEFAULT_INTERVAL
    return interval


def batch_load_id(stream: str, query_id: str, batch_id: int) -> str:
    """The same batch of the same checkpoint always has the same load id, which makes a replay recognisable."""
    return f"{stream}-{query_id}-{batch_id:020d}"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: a new checkpoint is a new stream, whatever its name."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()[0]


def _start(
    writer: DataStreamWriter, stream: str, checkpoint: str, interval: str | float | None, drain: bool
) -> StreamingQuery:
    writer = writer.queryName(stream).option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=commit_interval(interval)).start()


def stream_append(
    feed: DataFrame,
    warehouse: Warehouse,
    schemas: Schemas,
    stream: str,
    checkpoint: str,
    interval: str | float | None = None,
    drain: bool = False,
    default_namespace: str | None = None,
    props: Mapping[str, str] | None = None,
    on_error: str | None = None,
    transforms: Sequence[Transform] = (),
) -> StreamingQuery:
    """Append a streaming change feed to the tables it names.

    ``transforms`` are run over each batch's rows of the tables they are for.

    Every batch is published per table under an id made of stream name, query id and batch number. A batch that is
    replayed from its checkpoint publishes only what is still missing, so each row arrives exactly once while the
    checkpoint lives; a new checkpoint reads the source anew. A failing batch stops the query; a restart from the
    checkpoint replays it.
    """
    if not feed.isStreaming:
        raise ValueError("stream_append needs a streaming frame; use Warehouse.load_feed for a batch")

    def append(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_load_id(stream, query_id(batch.sparkSession, checkpoint), batch_id)
        warehouse.append_batch(batch, schemas, load_id, props, default_namespace, on_error, transforms=transforms)

    return _start(feed.writeStream.foreachBatch(append), stream, checkpoint, interval, drain)


def stream_table(
    rows: DataFrame,
    table: Table,
    stream: str,
    checkpoint: str,
    interval: str | float | None = None,
    drain: bool = False,
    **load_options: object,
) -> StreamingQuery:
    """Append a stream of typed rows to one table; ``load_options`` go to ``Table.load``. Every batch is measured."""
    if not rows.isStreaming:
        raise ValueError("stream_table needs a streaming frame; use Table.load for a batch")

    def append(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_load_id(stream, query_id(batch.sparkSession, checkpoint), batch_id)
        table.load(batch, load_id=load_id, **{"measure": True, **load_options})

    return _start(rows.writeStream.foreachBatch(append), stream, checkpoint, interval, drain)


def load_messages(
    messages: DataFrame, table: Table, rejects: Table, cols: Sequence[ColSchema], load_id: str, value: str = "value"
) -> tuple[int, int]:
    """Messages that hold all declared columns go into ``table``, the others into ``rejects``: whole, with the reason.

    Both are loaded under one id. A retry loads only what is missing, so that each message is once in exactly one of the
    two, whatever the first attempt had done. Rows loaded and rejected.
    """
    sorted_out = quarantined(messages, cols, value).persist()
    try:
        good = table.load(sorted_out.filter("_reason is null").drop("_reason", REJECTED), cols, load_id, measure=True)
        bad = sorted_out.filter("_reason is not null")
        keys = [c for c in DEDUPE_KEYS if c in bad.columns]
        bad = bad.select(*keys, F.col(REJECTED).alias("message"), F.col("_reason").alias("reason"))
        return good.rows, rejects.load(bad, load_id=load_id, measure=True).rows
    finally:
        sorted_out.unpersist()


def stream_messages(
    messages: DataFrame,
    table: Table,
    rejects: Table,
    cols: Sequence[ColSchema],
    stream: str,
    checkpoint: str,
    interval: str | float | None = None,
    drain: bool = False,
    value: str = "value",
) -> StreamingQuery:
    """``load_messages`` batch by batch."""

    def append(batch: DataFrame, batch_id: int) -> None:
        load_messages(batch, table, rejects, cols, batch_load_id(stream, query_id(batch.sparkSession, checkpoint), batch_id), value)

    return _start(messages.writeStream.foreachBatch(append), stream, checkpoint, interval, drain)


def drain_and_stop(query: StreamingQuery) -> None:
    """Process what has arrived, publish it, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def transfer(
    source: DataFrame,
    warehouse: Warehouse,
    schemas: Schemas,
    name: str,
    checkpoint: str | None = None,
    mode: str | None = None,
    run: str | None = None,
    **options: object,
):
    """Pick the load mode: streams are appended, frames are bulk-loaded; anything else is refused.

    A bulk load takes the source anew each time it is called. ``run`` names one run, so that it can be retried.
    """
    chosen = mode or ("append_stream" if source.isStreaming else "snapshot")
    if chosen == "append_stream" and source.isStreaming:
        if checkpoint is None:
            raise ValueError("a stream needs a checkpoint folder")
        return stream_append(source, warehouse, schemas, name, checkpoint, **options)
    if chosen == "snapshot" and not source.isStreaming:
        return warehouse.load_feed(source, schemas, f"{name}-{run or uuid.uuid4().hex}", mode="replace", **options)
    raise ValueError("only a snapshot of a frame and an append-only stream are supported")
