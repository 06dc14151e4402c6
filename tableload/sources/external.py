"""Sources outside the warehouse: relational tables, document collections, message topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

MESSAGE_COLUMNS = ("_topic", "_partition", "_offset", "_timestamp", "key", "value")


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_240,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a relational table, split into ranges of one column."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is not None:
        if bounds is None or partitions < 1:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def relational_table(spark: SparkSession, **options: object) -> DataFrame:
    """All rows of a relational table (the driver jar must be on the class path); see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def document_collection(spark: SparkSession, paths: str | Sequence[str], id_field: str = "_id") -> DataFrame:
    """One row per JSON line: the document's id as text, and the whole document."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    return lines.select(
        F.get_json_object("value", f"$['{id_field}']").alias("_id"), F.col("value").alias("document")
    )


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic as a stream (the connector jar must be on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    raw = reader.options(**options).load()
    return raw.select(
        F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        F.col("timestamp").alias("_timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def message_files(
    spark: SparkSession, path: str, topic: str, stream: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    """Messages landed as Parquet files of ``key`` and ``value``; a file's path and row stand for partition and offset."""
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema("key string, value string").parquet(path).select(
        F.lit(topic).alias("_topic"),
        F.col("_metadata.file_path").alias("_partition"),
        F.col("_metadata.row_index").alias("_offset"),
        F.col("_metadata.file_modification_time").alias("_timestamp"),
        "key",
        "value",
    )


def row_files(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Rows arriving as Parquet files in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
