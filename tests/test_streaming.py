import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tableload import ColSchema, stream_append, stream_table, table_to_changes, transfer
from tableload.operators.feed import control_events
from tableload.operators.messages import dedupe_messages
from tableload.session import remove_folder
from tableload.sources.external import message_files, row_files
from tableload.streaming.append import batch_load_id, commit_interval, drain_and_stop, query_id

COLS = [ColSchema("id", "int64", primary_key=True, required=True), ColSchema("name", "string", required=True)]
SCHEMA = "id bigint, name string"


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    for i in range(3):
        rows = spark.createDataFrame([(i * 10 + j, f"n{j % 2}") for j in range(4)], SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def feed(spark, landing, files=1):
    rows = row_files(spark, landing, SCHEMA, files)
    return table_to_changes(rows, "", F.col("name"))


SCHEMAS = {("streaming", "n0"): COLS, ("streaming", "n1"): COLS}


def ids(warehouse, *names):
    return sorted(r["id"] for n in names for r in warehouse.table("streaming", n).read().collect())


ALL = sorted(i * 10 + j for i in range(3) for j in range(4))


def test_commit_interval():
    assert commit_interval(None) == commit_interval(0) == commit_interval(-1) == "1 minute"
    assert commit_interval(0.5) == "500 milliseconds"
    assert commit_interval("10 seconds") == "10 seconds"


def test_fan_out_with_default_namespace(spark, warehouse, landing, checkpoint):
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, drain=True, default_namespace="streaming").awaitTermination()
    assert ids(warehouse, "n0", "n1") == ALL
    assert [e.load_id for e in warehouse.table("streaming", "n0").entries()] == [batch_load_id("s", query_id(spark, checkpoint), i) for i in range(3)]


def test_two_pushes_are_both_visible(spark, warehouse, landing, checkpoint):
    """A stream that goes on running: what arrives later is published at a later commit."""
    table = warehouse.table("public", "streaming_test")
    query = stream_table(row_files(spark, landing, SCHEMA), table, "s", checkpoint, interval=0.2, cols=COLS)
    query.processAllAvailable()
    assert table.count() == 12
    spark.createDataFrame([(99, "late")], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    drain_and_stop(query)
    assert table.count() == 13 and not query.isActive


def test_replay_of_an_uncommitted_batch(spark, warehouse, landing, checkpoint):
    """The batch was published, but the stream died before noting it: the replay publishes nothing twice."""
    options = {"drain": True, "default_namespace": "streaming"}
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, **options).awaitTermination()
    for name in glob.glob(f"{checkpoint}/commits/*2") + glob.glob(f"{checkpoint}/commits/.2*"):
        os.unlink(name)
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, **options).awaitTermination()
    assert ids(warehouse, "n0", "n1") == ALL


def test_failed_batch_is_completed_by_the_restart(spark, warehouse, landing, checkpoint):
    broken = SCHEMAS | {("streaming", "n1"): [*COLS, ColSchema("absent", "string", required=True)]}
    options = {"drain": True, "default_namespace": "streaming"}
    with pytest.raises(StreamingQueryException):
        stream_append(feed(spark, landing), warehouse, broken, "s", checkpoint, **options).awaitTermination()
    assert not warehouse.table_exists("streaming", "n1")
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, **options).awaitTermination()
    assert ids(warehouse, "n0", "n1") == ALL


def test_rows_staged_by_a_dead_batch_are_replaced(spark, warehouse, landing, checkpoint):
    options = {"drain": True, "default_namespace": "streaming"}
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, **options).awaitTermination()
    # as if the stream had died before it published the last batch
    last = batch_load_id("s", query_id(spark, checkpoint), 2)
    for name in glob.glob(f"{checkpoint}/commits/*2") + glob.glob(f"{checkpoint}/commits/.2*"):
        os.unlink(name)
    for table in ("n0", "n1"):
        remove_folder(spark, f"{warehouse.root}/ledger/ns=streaming/table={table}/span=0/load={last}")
    stale = f"{warehouse.root}/data/ns=streaming/table=n0/_load_id={last}"
    spark.createDataFrame([(777, "stale")], SCHEMA).write.mode("append").parquet(stale)
    stream_append(feed(spark, landing), warehouse, SCHEMAS, "s", checkpoint, **options).awaitTermination()
    assert ids(warehouse, "n0", "n1") == ALL


def test_a_new_checkpoint_reads_the_source_anew(spark, warehouse, landing, tmp_path):
    table = warehouse.table("public", "t")
    for i in range(2):
        stream_table(row_files(spark, landing, SCHEMA), table, "s", str(tmp_path / f"c{i}"), drain=True, cols=COLS).awaitTermination()
    assert table.count() == 24


def test_a_second_transfer_of_one_name_loads_anew(spark, warehouse):
    schemas = {("", "t"): COLS}
    for n in (3, 5):
        rows = spark.createDataFrame([(n, "x")] * n, SCHEMA)
        transfer(table_to_changes(rows, "", "t"), warehouse, schemas, "name")
        assert [r.id for r in warehouse.table("", "t").read().collect()] == [n] * n
    rows = spark.createDataFrame([(7, "x")], SCHEMA)
    for _ in range(2):
        transfer(table_to_changes(rows, "", "t"), warehouse, schemas, "name", run="retried")
    assert len(warehouse.table("", "t").entries()) == 3


@pytest.mark.parametrize("kind", ["drop", "truncate"])
def test_a_retried_feed_cleans_up_once(spark, warehouse, kind):
    rows = table_to_changes(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), "", "t")
    warehouse.table("", "t").load(spark.createDataFrame([(9, "old")], SCHEMA), COLS)
    feed = rows.unionByName(control_events(spark.range(1), F.lit(kind), F.lit(""), F.lit("t")))
    for _ in range(2):
        warehouse.load_feed(feed, {("", "t"): COLS}, "bulk")
        assert sorted(r.id for r in warehouse.table("", "t").read().collect()) == [1, 2]
    assert not os.path.exists(f"{warehouse.root}/staging/load=bulk")


def test_rows_of_an_unknown_kind_are_refused(spark, warehouse):
    rows = table_to_changes(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), "", "t")
    odd = rows.withColumn("kind", F.expr("case when lsn is null and rand() >= 0 then 'upsert' else kind end"))
    for unknown in (odd, rows.withColumn("kind", F.lit(None).cast("string"))):
        with pytest.raises(ValueError, match="unknown kind"):
            warehouse.load_feed(unknown, {("", "t"): COLS})


def test_messages_of_files_with_one_name(spark, tmp_path):
    for folder in ("a", "b"):
        spark.createDataFrame([("k", folder)], "key string, value string").coalesce(1).write.parquet(str(tmp_path / folder))
    rows = message_files(spark, str(tmp_path / "*"), "t", stream=False)
    assert rows.select("_partition", "_offset").distinct().count() == 2


def test_control_events_are_ignored_and_updates_refused(spark, warehouse, landing, checkpoint, tmp_path):
    marked = feed(spark, landing).withColumn("kind", F.when(F.col("table") == "n0", F.lit("truncate")).otherwise(F.col("kind")))
    stream_append(marked, warehouse, SCHEMAS, "s", checkpoint, drain=True, default_namespace="streaming").awaitTermination()
    assert not warehouse.table_exists("streaming", "n0") and len(ids(warehouse, "n1")) == 6
    updates = feed(spark, landing).withColumn("kind", F.lit("update"))
    with pytest.raises(StreamingQueryException, match="only inserts"):
        stream_append(updates, warehouse, SCHEMAS, "u", str(tmp_path / "u"), drain=True, default_namespace="streaming").awaitTermination()


def test_mode_is_chosen_by_the_source(spark, warehouse, landing, checkpoint):
    schemas = {("", "n0"): COLS, ("", "n1"): COLS}
    bulk = table_to_changes(spark.read.schema(SCHEMA).parquet(landing), "", F.col("name"))
    assert sum(e.rows for e in transfer(bulk, warehouse, schemas, "bulk")) == 12
    with pytest.raises(ValueError):
        transfer(bulk, warehouse, schemas, "x", mode="append_stream")
    with pytest.raises(ValueError):
        transfer(feed(spark, landing), warehouse, schemas, "x", checkpoint, mode="snapshot")
    with pytest.raises(ValueError):
        transfer(feed(spark, landing), warehouse, schemas, "x")
    with pytest.raises(ValueError):
        stream_append(bulk, warehouse, schemas, "x", checkpoint)
    with pytest.raises(ValueError):
        stream_table(bulk, warehouse.table("", "x"), "x", checkpoint)
    transfer(feed(spark, landing), warehouse, schemas, "live", checkpoint, drain=True).awaitTermination()
    assert warehouse.table("", "n0").count() == 12


def test_stream_dedupe_needs_a_watermark(spark, warehouse, landing, checkpoint, tmp_path):
    rows = row_files(spark, landing, SCHEMA).withColumn("at", F.timestamp_seconds(F.col("id") + 1_000_000))
    with pytest.raises(ValueError):
        dedupe_messages(rows, ["id"])
    spark.read.schema(SCHEMA).parquet(landing).coalesce(1).write.mode("append").parquet(landing)
    once = dedupe_messages(rows, ["id"], ("at", "1 hour"))
    table = warehouse.table("ns", "once")
    stream_table(once, table, "d", checkpoint, drain=True).awaitTermination()
    assert table.count() == 12
