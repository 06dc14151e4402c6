import pytest
from pyspark.sql import functions as F, types as T

from tableload import ColSchema, from_struct_type, to_struct_type, with_keys
from tableload.functions.names import id_name, id_namespace, join_id, parse_id, split_id
from tableload.functions.types import (
    CANONICAL_NAME,
    STORED_NAME,
    canonical_name,
    canonical_type,
    identifier_columns,
    lake_type_name,
)

LAKE_TYPES = {
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
    "decimal(10, 2)": "any",
    "fixed[25]": "any",
    "time": "any",
    "list": "any",
    "map": "any",
    "struct": "any",
}


def test_canonical_names_by_value_and_by_column(spark):
    df = spark.createDataFrame([(k,) for k in LAKE_TYPES], "name string")
    found = {r[0]: r[1] for r in df.select("name", canonical_type(F.col("name"))).collect()}
    assert found == LAKE_TYPES
    assert {k: canonical_name(k) for k in LAKE_TYPES} == LAKE_TYPES


def test_every_canonical_type_has_a_stored_type():
    schema = to_struct_type([ColSchema(f"c_{c}", c) for c in STORED_NAME])
    assert [f.dataType.simpleString() for f in schema] == [
        "bigint", "int", "int", "int", "bigint", "bigint", "int", "int", "float", "double", "binary", "string",
        "boolean", "date", "timestamp", "timestamp", "string", "string",
    ]
    assert set(CANONICAL_NAME.values()) <= set(STORED_NAME)


def test_unknown_canonical_type_is_stored_as_text():
    assert to_struct_type([ColSchema("c", "geometry")])["c"].dataType == T.StringType()


def test_schema_round_trip_keeps_flags_and_native_types():
    cols = [
        ColSchema("id", "int64", primary_key=True, required=True),
        ColSchema("small", "uint8"),
        ColSchema("amount", "any", native=T.DecimalType(10, 2)),
        ColSchema("tags", "any", native=T.ArrayType(T.StringType())),
        ColSchema("doc", "any"),
    ]
    assert from_struct_type(to_struct_type(cols)) == cols


def test_missing_schema_is_an_error():
    with pytest.raises(ValueError):
        to_struct_type(None)


def test_identifier_needs_key_and_required():
    cols = [
        ColSchema("a", "int64", primary_key=True, required=True),
        ColSchema("b", "int64", primary_key=True),
        ColSchema("c", "int64", required=True),
    ]
    assert identifier_columns(to_struct_type(cols)) == ["a"]
    assert identifier_columns(to_struct_type(with_keys(cols, ["b"]))) == ["a", "b"]


def test_reserved_name():
    assert to_struct_type([ColSchema("_partition", "string")]).names == ["_partition_tr"]


def test_lake_type_names():
    assert lake_type_name(T.DecimalType(10, 2)) == "decimal(10, 2)"
    assert lake_type_name(T.TimestampNTZType()) == "timestamp"
    assert lake_type_name(T.TimestampType()) == "timestamptz"
    assert lake_type_name(T.ArrayType(T.LongType())) == "list"


@pytest.mark.parametrize("table_id, expected", [("t", ("", "t")), ("a.t", ("a", "t")), ("a.b.t", ("a.b", "t"))])
def test_identifiers(spark, table_id, expected):
    namespace, name = split_id(F.lit(table_id))
    parts = F.split(F.lit(table_id), r"\.")
    row = spark.range(1).select(namespace, name, id_namespace(parts), id_name(parts), join_id(namespace, name)).first()
    assert tuple(row) == expected + expected + (table_id,)
    assert parse_id(table_id) == expected
