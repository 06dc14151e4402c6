"""Canonical column types, and both directions of the map to Spark types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F, types as T


@dataclass(frozen=True)
class ColSchema:
    """One declared column.

    ``native`` keeps a Spark type that the canonical name does not describe (decimals, nested types,
    timestamps without zone); it is used instead of the canonical type's stored form.
    """

    name: str
    data_type: str
    primary_key: bool = False
    required: bool = False
    native: T.DataType | None = None


# Canonical type -> type name in a stored table.
STORED_NAME = {
    "int64": "long",
    "int32": "int",
    "int16": "int",
    "int8": "int",
    "uint64": "long",
    "uint32": "long",
    "uint16": "int",
    "uint8": "int",
    "float32": "float",
    "float64": "double",
    "bytes": "binary",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamptz",
    "timestamp": "timestamptz",
    "interval": "string",
    "any": "string",
}

# Type name in a stored table -> canonical type; every other name is "any".
CANONICAL_NAME = {
    "long": "int64",
    "int": "int32",
    "float": "float32",
    "double": "float64",
    "binary": "bytes",
    "string": "string",
    "uuid": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "timestamptz": "timestamp",
}

# Type name of a variant's value -> type name in a stored table, where they differ.
VARIANT_NAME = {"bigint": "long", "timestamp_ntz": "timestamp", "timestamp": "timestamptz"}

SPARK_TYPE = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
}

# A column of this name is stored under the other one.
RESERVED_NAME = {"_partition": "_partition_tr"}


def stored_name(name: str) -> str:
    return RESERVED_NAME.get(name, name)


def stored_type(col: ColSchema) -> T.DataType:
    if col.native is not None:
        return col.native
    return SPARK_TYPE[STORED_NAME.get(col.data_type, "string")]


def lake_type_name(dtype: T.DataType) -> str:
    """Spark type -> the type name a table format would show, e.g. ``decimal(10, 2)``."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int"
    if isinstance(dtype, T.LongType):
        return "long"
    if isinstance(dtype, T.TimestampNTZType):
        return "timestamp"
    if isinstance(dtype, T.TimestampType):
        return "timestamptz"
    if isinstance(dtype, T.DecimalType):
        return f"decimal({dtype.precision}, {dtype.scale})"
    if isinstance(dtype, T.ArrayType):
        return "list"
    return dtype.typeName()


def canonical_name(lake_type: str) -> str:
    """Type name with its parameters cut off, looked up; ``any`` when there is no rule."""
    return CANONICAL_NAME.get(lake_type.split("(")[0].split("[")[0], "any")


def canonical_type(lake_type: Column) -> Column:
    """``canonical_name`` as a column expression."""
    rules = F.create_map(*[F.lit(x) for pair in CANONICAL_NAME.items() for x in pair])
    base = F.regexp_extract(lake_type, r"^([^(\[]*)", 1)
    return F.coalesce(F.try_element_at(rules, base), F.lit("any"))


def value_type_name(value: Column) -> Column:
    """Type name, as in a table, of what a variant holds: ``DECIMAL(5,2)`` -> ``decimal(5,2)``."""
    held = F.lower(F.schema_of_variant(value))
    names = F.create_map(*[F.lit(x) for pair in VARIANT_NAME.items() for x in pair])
    return F.coalesce(F.try_element_at(names, held), held)


def to_struct_type(cols: Sequence[ColSchema] | None) -> T.StructType:
    """Declared columns -> stored schema; key, required and canonical type go in the field metadata."""
    if cols is None:
        raise ValueError("a table needs a declared schema")
    fields = []
    for col in cols:
        meta = {"canonical": col.data_type, "primary_key": col.primary_key, "required": col.required}
        fields.append(T.StructField(stored_name(col.name), stored_type(col), True, meta))
    return T.StructType(fields)


def from_struct_type(schema: T.StructType, nested: str = "native") -> list[ColSchema]:
    """Stored schema -> declared columns.

    ``nested="native"`` keeps the Spark type of decimal, nested and zone-less columns,
    ``nested="json"`` reduces them to their canonical type.
    """
    cols = []
    for field in schema.fields:
        meta = field.metadata or {}
        canonical = meta.get("canonical") or canonical_name(lake_type_name(field.dataType))
        col = ColSchema(
            field.name,
            canonical,
            bool(meta.get("primary_key", False)),
            bool(meta.get("required", False)),
        )
        if nested == "native" and stored_type(col) != field.dataType and not _widened(field.dataType):
            col = replace(col, native=field.dataType)
        cols.append(col)
    return cols


def _widened(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType))


def with_keys(cols: Iterable[ColSchema], keys: Sequence[str]) -> list[ColSchema]:
    """The same columns with ``keys`` marked as required primary key."""
    return [replace(c, primary_key=True, required=True) if c.name in keys else c for c in cols]


def identifier_columns(schema: T.StructType) -> list[str]:
    """Identifier columns: primary key and required."""
    return [
        f.name for f in schema.fields if f.metadata.get("primary_key", False) and f.metadata.get("required", False)
    ]
