"""The change feed: self-describing rows of many tables, and control events, in one frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableload.functions.convert import name_sql, text_sql, to_variant
from tableload.functions.names import default_namespace, join_id
from tableload.functions.types import ColSchema, stored_name
from tableload.operators.conform import conform

# Kinds of feed rows.
ROW_KINDS = ("insert", "update", "delete")
DONE_KINDS = ("done_table", "done_sharded")
CLEANUP_KINDS = ("drop", "truncate")

FEED_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("load_part", T.StringType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("commit_time", T.LongType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("column_values", T.ArrayType(T.VariantType())),
    ]
)


def table_to_changes(
    df: DataFrame,
    namespace: str | Column,
    table: str | Column,
    snapshot_id: str = "",
    commit_time_ns: int | None = None,
    lsn: Column | None = None,
    load_part: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as an insert item that carries its column names and values.

    ``namespace`` and ``table`` are the same for all rows, or given per row by a column.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    return df.select(
        F.lit("insert").alias("kind"),
        (namespace if isinstance(namespace, Column) else F.lit(namespace)).alias("namespace"),
        (table if isinstance(table, Column) else F.lit(table)).alias("table"),
        (F.lit("") if load_part is None else load_part.cast("string")).alias("load_part"),
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(commit_time_ns).cast("bigint").alias("commit_time"),
        (F.lit(None) if lsn is None else lsn).cast("bigint").alias("lsn"),
        F.array(*[F.lit(f.name) for f in fields]).alias("column_names"),
        F.expr(f"array({', '.join(to_variant(name_sql(f.name), f.dataType) for f in fields)})").alias("column_values"),
    )


def control_events(
    df: DataFrame, kind: Column, namespace: Column, table: Column, lsn: Column | None = None, load_part: Column | None = None, parts: Column | None = None
) -> DataFrame:
    """Rows of ``df`` as control events: a kind and a table, no values.

    ``lsn`` places an event among the rows of its feed; ``load_part`` names the part that has ended (``done_table``), ``parts`` (array of
    text) the parts that make up a load (``done_sharded``).
    """
    empty = {f.name: F.lit(None).cast(f.dataType) for f in FEED_SCHEMA.fields}
    given = {"lsn": lsn, "load_part": load_part, "column_names": parts}
    empty.update(kind=kind, namespace=namespace, table=table, **{k: v.cast(FEED_SCHEMA[k].dataType) for k, v in given.items() if v is not None})
    return df.select(*[empty[f.name].alias(f.name) for f in FEED_SCHEMA.fields])


def row_events(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("kind").isin(*ROW_KINDS))


def split_events(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row events, and everything else."""
    is_row = F.coalesce(F.col("kind").isin(*ROW_KINDS), F.lit(False))
    return feed.filter(is_row), feed.filter(~is_row)


def with_default_namespace(feed: DataFrame, default: str | None) -> DataFrame:
    """Rows without a namespace get the default one, if any, else the empty name."""
    return feed.withColumn("namespace", default_namespace(F.col("namespace"), default or ""))


def include_tables(df: DataFrame, include: Iterable[str] | None) -> DataFrame:
    """Rows of the listed tables (``namespace.name``); no list means all."""
    if include is None:
        return df
    return df.filter(join_id(F.col("namespace"), F.col("table")).isin(*include))


def feed_columns(feed: DataFrame, cols: Sequence[ColSchema], extra: Sequence[str] = ()) -> DataFrame:
    """Feed rows of one table as a frame of variants, one column per declared one.

    A value is found by name: null if absent, the first one if repeated. Items of one table nearly
    always list their columns in declared order; that test is shared by all columns of a row and spares
    the search per column.
    """
    listed = ", ".join(text_sql(c.name) for c in cols)
    out = [
        f"case when _in_order then get(column_values, {i}) else try_element_at(column_values, "
        f"cast(nullif(array_position(column_names, {text_sql(c.name)}), 0) as int)) end as {name_sql(stored_name(c.name))}"
        for i, c in enumerate(cols)
    ]
    kept = ["column_names", "column_values", *[name_sql(e) for e in extra]]
    tested = feed.selectExpr(*kept, f"column_names = array({listed}) as _in_order")
    return tested.selectExpr(*out, *[name_sql(e) for e in extra])


def restore_values(feed: DataFrame, cols: Sequence[ColSchema]) -> DataFrame:
    """Feed rows of one table back in canonical types; null stays null."""
    return conform(feed_columns(feed, cols), cols)


def clean_up_points(feed: DataFrame) -> DataFrame:
    """(namespace, table, kind, lsn): the last clean-up event of each kind and table; null where none states its position."""
    events = feed.filter(F.col("kind").isin(*CLEANUP_KINDS))
    return events.groupBy("namespace", "table", "kind").agg(F.max("lsn").alias("lsn"))


def after_clean_up(feed: DataFrame, points: DataFrame) -> DataFrame:
    """Rows that come after the last clean-up event of their table.

    A row is void if its position is at or before that event's. Rows and events without a position do not compare: an
    event without one acts before all rows, a row without one comes after all events.
    """
    last = points.groupBy(F.col("namespace").alias("_ns"), F.col("table").alias("_table")).agg(F.max("lsn").alias("_after"))
    joined = feed.join(last, (F.col("namespace") == F.col("_ns")) & (F.col("table") == F.col("_table")), "left")
    later = F.coalesce(F.col("lsn") > F.col("_after"), F.lit(True))
    return joined.filter(later).drop("_ns", "_table", "_after")


def only_table(feed: DataFrame, namespace: str, table: str) -> DataFrame:
    return feed.filter((F.col("namespace") == namespace) & (F.col("table") == table))


def route(
    feed: DataFrame, schemas: Mapping[tuple[str, str], Sequence[ColSchema]], default: str | None = None
) -> dict[tuple[str, str], DataFrame]:
    """One frame of conformed rows per declared table."""
    rows = row_events(with_default_namespace(feed, default))
    return {key: restore_values(only_table(rows, *key), cols) for key, cols in schemas.items()}


def feed_summary(feed: DataFrame) -> DataFrame:
    """Rows per table and kind: one narrow pass, pre-aggregated before the shuffle."""
    return feed.groupBy("namespace", "table", "kind").agg(F.count(F.lit(1)).alias("rows"))
