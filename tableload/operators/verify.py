"""Checks of a load against its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tableload.operators.conform import quoted

KEY = ["namespace", "table"]


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected and actual rows per table; either side may lack a table. Inputs: namespace, table, rows."""
    left = expected.groupBy(*KEY).agg(F.sum("rows").alias("expected"))
    right = actual.groupBy(*KEY).agg(F.sum("rows").alias("actual"))
    joined = left.join(right, KEY, "full_outer").select(
        *KEY, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")
    )
    return joined.withColumn("difference", F.col("actual") - F.col("expected"))


def count_rows(df: DataFrame, namespace: str, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(namespace).alias("namespace"), F.lit(table).alias("table"), "rows"
    )


def value_bytes(df: DataFrame) -> Column:
    """Size of a row's values: text and binary by length, other values by their fixed width."""
    width = F.lit(0)
    for field in df.schema.fields:
        col = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(col)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(col))
        else:
            size = F.when(col.isNotNull(), F.lit(_width(field.dataType)))
        width = width + F.coalesce(size, F.lit(0))
    return width.cast("bigint")


def _width(dtype: T.DataType) -> int:
    if isinstance(dtype, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dtype, T.ShortType):
        return 2
    if isinstance(dtype, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dtype, T.DecimalType):
        return 16
    return 8


def load_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and value bytes, per group of ``by`` if given."""
    sized = df.select(*[quoted(b) for b in by], value_bytes(df).alias("_bytes"))
    return sized.groupBy(*[quoted(b) for b in by]).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes")
    )


def observed(df: DataFrame, name: str = "load", columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The frame with rows and value bytes (of ``columns``, if given) observed while it is written; a retried task may count twice."""
    seen = Observation(name)
    sized = df if columns is None else df.select(*[quoted(c) for c in columns])
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(value_bytes(sized)).alias("bytes")), seen


def _comparable(df: DataFrame) -> DataFrame:
    """Columns by name; nested values and variants as JSON text that shows nulls at every depth."""

    def column(field: T.StructField) -> Column:
        col = quoted(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.to_json(col, {"ignoreNullFields": "false"}).alias(field.name)
        return col

    return df.select(*[column(f) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows and an order-free hash: row hashes summed as decimals, so that no overflow occurs."""
    rows = _comparable(df)
    row_hash = _row_hash(rows).cast("decimal(20,0)")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("decimal(38,0)").alias("hash")
    )


def canon_compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Whether two frames hold the same columns and rows, and how many rows each side lacks.

    Equal row hashes are counted on both sides first: copies collapse before the shuffle, and only eight
    bytes per row are moved. ``difference_rows`` shows the rows themselves.
    """
    if _signature(expected) != _signature(actual):
        counted = expected.select(F.lit(1).alias("e"), F.lit(0).alias("a")).union(actual.select(F.lit(0), F.lit(1)))
        return counted.agg(
            F.lit(False).alias("same_schema"),
            F.lit(False).alias("same_rows"),
            F.coalesce(F.sum("e"), F.lit(0)).alias("missing"),
            F.coalesce(F.sum("a"), F.lit(0)).alias("extra"),
        )
    sides = _hashes(expected, 1).unionByName(_hashes(actual, -1))
    balance = sides.groupBy("hash").agg(F.sum("n").alias("n"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(-F.col("n"), F.lit(0))), F.lit(0)).alias("extra"),
    ).select(
        F.lit(True).alias("same_schema"),
        ((F.col("missing") == 0) & (F.col("extra") == 0)).alias("same_rows"),
        "missing",
        "extra",
    )


def _hashes(df: DataFrame, sign: int) -> DataFrame:
    rows = _comparable(df)
    return rows.select(_row_hash(rows).alias("hash"), F.lit(sign).cast("bigint").alias("n"))


def _row_hash(rows: DataFrame) -> Column:
    """Nulls are hashed as such: Spark's hash of several columns passes over them."""
    return F.xxhash64(*[c for name in rows.columns for c in (quoted(name).isNull(), quoted(name))], F.lit(len(rows.columns)))


def _signature(df: DataFrame) -> list[tuple[str, str]]:
    return sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)


def difference_rows(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows on one side only, duplicates counted, with the side they are on."""
    left, right = _comparable(expected), _comparable(actual)
    missing = left.exceptAll(right).withColumn("side", F.lit("missing"))
    return missing.unionByName(right.exceptAll(left).withColumn("side", F.lit("extra")))
