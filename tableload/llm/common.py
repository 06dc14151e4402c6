"""Helpers shared by the operators: stored intermediate tables, free column names, connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tableload.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: the lineage ends here, lost executors lose nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores until no column is called so; Spark's names ignore case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text):
    """A-Z lower-cased, all else kept; null becomes the empty text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that one slice holds about ``most_bytes``, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def array_slices(column: pa.Array, most_bytes: int = 8 << 20) -> Iterator[pa.Array]:
    """An Arrow column cut as by ``text_slices``; none of an empty one."""
    step = max(1, int(len(column) * most_bytes / max(column.nbytes, 1)))
    for start in range(0, len(column), step):
        yield column.slice(start, step)


def release_memory() -> None:
    """Give what a worker has freed back to the system: workers live on, and later stages need the room."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no GNU C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b) with a > b."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    pairs = large.join(low, "a")
    return (
        pairs.select("a", F.col("m").alias("b"))
        .unionByName(pairs.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Alternating large-star and small-star steps [Kiveris et al., 2014] until the links no longer change. Each
    step is stored; only a count and a checksum of the links come to the driver.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links, seen = stored(ordered, name), None
    while True:
        row = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        if row[0] == row[2] and tuple(row) == seen or row[0] == 0:
            break
        seen = tuple(row)
        links = stored(_stars(links), name)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


