"""Plans: what reaches the scan, and what is shuffled."""

import os
import shutil
import time

from pyspark.sql import functions as F

from tableload import table_to_changes
from tableload.functions.types import from_struct_type
from tableload.operators.feed import feed_columns, only_table, with_default_namespace


def wide(spark, rows=1000):
    return spark.range(rows).selectExpr(
        "id as key", "cast(id as string) as text", "id * 1.5D as amount", "date_add(date'2020-01-01', cast(id as int)) as day"
    )


def test_projection_and_filter_reach_the_scan(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    table.load(wide(spark))
    text = plan(table.read(["key"], "amount > 100"))
    assert "ReadSchema: struct<key:bigint,amount:double>" in text
    assert "GreaterThan(amount,100.0)" in text
    assert "Exchange" not in text


def test_only_visible_loads_are_listed(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    for i in range(3):
        table.load(wide(spark), load_id=f"load-{i}")
    one = table.read(since=2)
    assert len(one.inputFiles()) and all("load-2" in f for f in one.inputFiles())


def test_between_prunes_partitions(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    table.load(wide(spark), partition_by=["years(day)"])
    pruned = table.read(["key"], between={"day": ("2021-01-01", "2021-06-30")})
    text = plan(pruned)
    assert "PartitionFilters: [isnotnull(_p_day_year" in text and "(_p_day_year#" in text
    assert pruned.count() == 181
    assert len({f for f in pruned.inputFiles()}) >= 1


def test_small_delete_sets_do_not_shuffle_the_table(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    table.load(wide(spark))
    table.delete_where("key < 10")
    text = plan(table.read(["key"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_files_without_deletes_skip_the_shuffle(spark, warehouse, plan):
    """Only rows of touched files are joined with the deletes, however many files that are."""
    table = warehouse.table("ns", "wide")
    for i in range(4):
        table.load(wide(spark).filter(F.col("key") % 4 == i))
    table.delete_where("key = 5")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = table.read(touched_only=True)
        text = plan(df)
        assert "Union" in text and text.count("SortMergeJoin") == 3
        assert df.count() == table.read().count() == 999
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_files_do_not_grow_with_tasks(spark, warehouse):
    feed = table_to_changes(wide(spark).repartition(32), "", F.concat(F.lit("t"), F.col("key") % 3))
    staged = warehouse._stage(with_default_namespace(feed, None), "load")
    assert len(staged.inputFiles()) == 3


def test_counts_read_no_columns(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    table.load(wide(spark), load_part=F.col("key") % 4)
    assert "ReadSchema: struct<>" in plan(table.read().groupBy().count())
    assert "ReadSchema: struct<_load_part:string>" in plan(table.manifest())


def test_feed_conversion_has_no_shuffle(spark, plan):
    df = wide(spark)
    feed = table_to_changes(df, "ns", "wide")
    text = plan(feed_columns(feed, from_struct_type(df.schema)))
    assert "Exchange" not in text


def test_staged_feed_prunes_other_tables(spark, warehouse, plan):
    df = wide(spark)
    feed = table_to_changes(df, "", F.concat(F.lit("t"), F.col("key") % 3))
    staged = warehouse._stage(with_default_namespace(feed, None), "load")
    text = plan(only_table(staged, "", "t1").filter("kind = 'insert'").select("lsn"))
    assert "PartitionFilters: [isnotnull(table#" in text and "Filter " not in text.replace("PartitionFilters", "")
    assert only_table(staged, "", "t1").count() == 333


def test_a_file_filter_prunes_the_scan(spark, warehouse):
    table = warehouse.table("ns", "wide")
    for i in range(4):
        table.load(wide(spark).coalesce(1))
    rows = table.read(positions=True)
    one = rows.select("_file").first()[0]
    scan = rows.filter(F.col("_file") == one)._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() >= 1
    assert scan.inputRDD().getNumPartitions() == 1


def test_messages_are_parsed_once(spark, plan):
    from tableload import ColSchema
    from tableload.operators.messages import parse_messages

    df = spark.range(10).selectExpr("to_json(named_struct('id', id, 'name', 'n')) as value")
    text = plan(parse_messages(df, [ColSchema("id", "int64"), ColSchema("name", "string")]))
    assert text.count("parseJson") == 1


def test_registered_reads_are_scans_alone(spark, warehouse, plan, tmp_path):
    """No join with the list of files, however many there are; files that come later stay unseen."""
    folder = str(tmp_path / "files")
    wide(spark, 900).repartition(300).write.parquet(folder)
    table = warehouse.table("ns", "wide")
    table.register([folder])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(table.read(["key"], "amount > 100"))
        assert "Exchange" not in text and "Join" not in text and "ReadSchema: struct<key:bigint,amount:double>" in text
        time.sleep(1.1)
        wide(spark, 5).write.mode("append").parquet(folder)
        assert "Join" not in plan(table.read()) and table.count() == 900
        late = next(f for f in os.listdir(folder) if f.startswith("part-"))
        shutil.copy2(f"{folder}/{late}", f"{folder}/part-moved.parquet")  # keeps its time: the list has to decide
        assert "Join" in plan(table.read()) and table.count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_delete_sets_shuffle_touched_files_only(spark, warehouse, plan):
    table = warehouse.table("ns", "wide")
    for i in range(8):
        table.load(wide(spark).filter(F.col("key") % 8 == i).coalesce(1))
    table.delete_where("key % 8 = 5 and key < 500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = table.read(["key"])
        text = plan(df)
        assert "Union" in text and text.count("Join") == 1
        assert sorted(r[0] for r in df.collect()) == [k for k in range(1000) if k % 8 != 5 or k >= 500]
        scans = scanned_files(df)
        assert sorted(scans)[0] == 1 and sorted(scans)[-1] == 7, "each file is scanned by one side only"
        assert table.compact().rows == 1000 - 62 and table.count() == 1000 - 62
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


EDGES = [0, 1, 7, 8, 63, 64, 32767, 32768, 65535, 65536, 99_999]


def deleted_by_the_thousand(spark, warehouse):
    """A table of one file, from which two sets of rows are deleted: their names take a few bytes on disk, much in memory."""
    table = warehouse.table("ns", "wide")
    table.load(spark.range(100_000).withColumnRenamed("id", "key").coalesce(1))
    table.delete_where("key % 3 = 1 and key % 7 <> 1")
    table.delete_where(F.col("key").isin(EDGES) | (F.col("key") % 5 == 2))
    return table, {k for k in range(100_000) if not (k % 3 == 1 and k % 7 != 1 or k in EDGES or k % 5 == 2)}


def test_deletes_that_outgrow_a_broadcast_in_memory_become_bitmaps(spark, warehouse):
    table, kept = deleted_by_the_thousand(spark, warehouse)
    df = table.read(["key"])
    rows = df.collect()
    assert len(rows) == len(kept) and {r[0] for r in rows} == kept
    assert broadcast_rows(df) == [4], "a row for each block of the file, not for each deleted row"
    assert {r[0] for r in table.read(["key"], positions=True).collect()} == kept and table.count() == len(kept)


def test_deletes_that_outgrow_the_bitmaps_are_not_broadcast(spark, warehouse, plan, monkeypatch):
    table, kept = deleted_by_the_thousand(spark, warehouse)
    monkeypatch.setattr("tableload.plans.table.BITMAP_BYTES", 0, raising=False)
    for touched_only in (None, False):
        df = table.read(["key"], touched_only=touched_only)
        rows = df.collect()
        assert len(rows) == len(kept) and {r[0] for r in rows} == kept
        assert "SortMergeJoin" in plan(df) and broadcast_rows(df) == []


def broadcast_rows(df):
    """Rows of each broadcast, once ``df`` has run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("BroadcastExchange"):
            out.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def scanned_files(df):
    """Files read by each scan of table rows, once ``df`` has run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet") and "_file#" not in node.simpleString(100).split("ReadSchema")[1]:
            if node.metrics().contains("numFiles") and "key" in node.simpleString(100):
                out.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out
