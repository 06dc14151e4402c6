"""Bringing a frame to a declared schema, with reports of what did not fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableload.functions.convert import convert, is_present, name_sql, no_value, text_sql, with_policy
from tableload.functions.types import (
    RESERVED_NAME,
    ColSchema,
    from_struct_type,
    identifier_columns,
    stored_name,
    stored_type,
)


def quoted(name: str) -> Column:
    return F.col(name_sql(name))


def source_field(df: DataFrame, name: str) -> T.StructField | None:
    """The source column of a declared one: by exact name, or a reserved name under either form."""
    fields = {f.name: f for f in reversed(df.schema.fields)}
    if name in fields:
        return fields[name]
    for before, after in RESERVED_NAME.items():
        if name in (before, after):
            return fields.get(before) or fields.get(after)
    return None


def _keep_native(field: T.StructField, col: ColSchema, nested: str) -> ColSchema:
    if nested == "native" and col.data_type == "any" and col.native is None:
        if not isinstance(field.dataType, (T.StringType, T.VariantType)):
            return replace(col, native=field.dataType)
    return col


def conform(
    df: DataFrame,
    cols: Sequence[ColSchema],
    on_error: str | None = None,
    nested: str = "json",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Declared columns only, in declared order and type.

    Columns are matched by name, absent ones are null, undeclared ones are dropped (but for ``extra``).
    ``on_error`` is ``null``, ``default`` or ``fail``; unset, required columns fail and others become null.
    """
    if nested not in ("json", "native"):
        raise ValueError(f"unknown nested mode {nested!r}")
    out = []
    for col in cols:
        field = source_field(df, col.name)
        if field is None:
            value = no_value(stored_type(col))
        else:
            value = with_policy(name_sql(field.name), field.dataType, _keep_native(field, col, nested), on_error)
        out.append(f"{value} as {name_sql(stored_name(col.name))}")
    return df.selectExpr(*out, *[name_sql(name) for name in extra])


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, without converting values: absent ones null, others dropped."""
    names = df.columns
    return df.select(
        *[
            (quoted(f.name) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def rename_reserved(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in RESERVED_NAME.items() if a in df.columns})


def _unpivot_counts(
    df: DataFrame, labels: Sequence[tuple], counts: Sequence[Sequence[str]], names: Sequence[str]
) -> DataFrame:
    """One aggregate pass over ``df``, turned into one row per label."""
    width = len(names) - len(labels[0])
    cells = [f"coalesce({c}, 0) as c{i}_{j}" for i, row in enumerate(counts) for j, c in enumerate(row)]
    totals = df.selectExpr(*cells)
    rows = [
        "named_struct("
        + ", ".join(
            [f"{text_sql(n)}, {_literal(v)}" for n, v in zip(names, label)]
            + [f"{text_sql(names[len(label) + j])}, cast(c{i}_{j} as bigint)" for j in range(width)]
        )
        + ")"
        for i, label in enumerate(labels)
    ]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def _literal(value: object) -> str:
    return text_sql(value) if isinstance(value, str) else str(value).lower()


def conform_report(df: DataFrame, cols: Sequence[ColSchema]) -> DataFrame:
    """Per declared column: values present in the source and values without a form in the declared type."""
    labels, counts = [], []
    for col in cols:
        field = source_field(df, col.name)
        labels.append((stored_name(col.name), col.data_type))
        if field is None:
            counts.append(("max(0)", "max(0)"))
            continue
        source = name_sql(field.name)
        present = is_present(source, field.dataType)
        failed = f"{present} and ({convert(source, field.dataType, col)}) is null"
        counts.append((f"count_if({present})", f"count_if({failed})"))
    return _unpivot_counts(df, labels, counts, ["column_name", "data_type", "present", "failed"])


def required_check(df: DataFrame, cols: Sequence[ColSchema]) -> DataFrame:
    """Per required column: rows without a value."""
    required = [c for c in cols if c.required]
    if not required:
        return df.sparkSession.createDataFrame([], "column_name string, missing bigint")
    counts = []
    for col in required:
        field = source_field(df, col.name)
        counts.append((f"count_if(not {is_present(name_sql(field.name), field.dataType)})" if field else "count(1)",))
    return _unpivot_counts(df, [(stored_name(c.name),) for c in required], counts, ["column_name", "missing"])


def require_values(df: DataFrame, cols: Sequence[ColSchema]) -> DataFrame:
    """The frame unchanged; reading it fails at the first row without a value in a required column."""
    names = [stored_name(c.name) for c in cols if c.required]
    if not any(name in df.columns for name in names):
        return df
    out = []
    for field in df.schema.fields:
        column = name_sql(field.name)
        if field.name in names:
            failure = f"raise_error({text_sql(f'required column {field.name} is null')})"
            column = f"coalesce({column}, cast({failure} as {field.dataType.simpleString()})) as {column}"
        out.append(column)
    return df.selectExpr(*out)


def describe_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` with canonical type and flags, and the values ``df`` holds in each."""
    keys = identifier_columns(schema)
    declared = from_struct_type(schema)
    labels = [
        (i + 1, c.name, c.data_type, schema[c.name].dataType.simpleString(), c.name in keys, c.required)
        for i, c in enumerate(declared)
    ]
    names = ["position", "column_name", "data_type", "stored_type", "primary_key", "required", "present"]
    return _unpivot_counts(df, labels, [(f"count({name_sql(c.name)})",) for c in declared], names)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Identifier values held by more than one row, with their row count."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")

