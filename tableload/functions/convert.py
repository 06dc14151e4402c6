"""Conversion of one column to a canonical type, as SQL expressions.

``convert`` gives null where a value has no form in the target type; what then happens (null, the type's
zero value, failure) is the caller's choice, see ``with_policy``. Expressions are SQL text: a wide table is
planned with one call per column, which matters for streams that plan every batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T

from tableload.functions.types import ColSchema, stored_type
from tableload.session import is_utc

# Range of each whole-number type; uint64 is kept in a signed 64-bit column.
INT_RANGE = {
    "int64": (-(2**63), 2**63 - 1),
    "int32": (-(2**31), 2**31 - 1),
    "int16": (-(2**15), 2**15 - 1),
    "int8": (-(2**7), 2**7 - 1),
    "uint64": (0, 2**63 - 1),
    "uint32": (0, 2**32 - 1),
    "uint16": (0, 2**16 - 1),
    "uint8": (0, 2**8 - 1),
}

# Accepted words of a boolean.
TRUE_WORDS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_WORDS = ("0", "f", "F", "FALSE", "false", "False")

# Accepted text forms.
INT_TEXT = "^[+-]?[0-9]+([.]0*)?$"
FLOAT_TEXT = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_WORD = "^(?i)([+-]?inf|[+-]?infinity|nan)$"
DATE_TEXT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ZONED_TEXT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
CLOCK_TEXT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$"

# timestamp_millis fails above the range of microseconds in a long
MAX_MILLIS = (2**63 - 1) // 1000

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)
_TIMES = "'DATE', 'TIMESTAMP', 'TIMESTAMP_NTZ'"
_TIME_KINDS = ("date", "datetime", "timestamp")
_FLOAT_KINDS = ("float32", "float64")


def name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def type_sql(dtype: T.DataType) -> str:
    return dtype.simpleString()


def no_value(dtype: T.DataType) -> str:
    return f"cast(null as {type_sql(dtype)})"


def convert(x: str, src: T.DataType, target: ColSchema) -> str:
    """``x`` of Spark type ``src`` as the stored type of ``target``; null where that fails."""
    out = stored_type(target)
    if target.native is not None:
        return x if src == target.native else _to_native(x, src, target.native)
    kind = target.data_type
    if isinstance(src, T.VariantType):
        return _from_variant(x, target)
    if isinstance(src, T.NullType):
        return no_value(out)
    if kind in INT_RANGE:
        return _to_int(x, src, kind, out)
    if kind in _FLOAT_KINDS:
        return _to_float(x, src, out)
    if kind == "bytes":
        return x if isinstance(src, T.BinaryType) else no_value(out)
    if kind == "boolean":
        return _to_bool(x, src)
    if kind == "date":
        return _to_date(x, src)
    if kind in _TIME_KINDS:
        return _to_timestamp(x, src)
    if kind == "any":
        return to_json_text(x, src)
    return to_text(x, src)


def _to_native(x: str, src: T.DataType, native: T.DataType) -> str:
    """Targets outside the canonical list: numbers and zone-less times are cast, the rest has no rule."""
    if isinstance(src, T.VariantType):
        return f"try_variant_get({x}, '$', '{type_sql(native)}')"
    if isinstance(native, T.DecimalType) and isinstance(src, (*_NUMERIC, T.StringType)):
        return f"try_cast({x} as {type_sql(native)})"
    if isinstance(native, T.TimestampNTZType):
        if isinstance(src, (T.DateType, T.TimestampType)):
            return f"cast({x} as timestamp_ntz)"
        if isinstance(src, T.StringType):
            return f"case when {x} rlike '{CLOCK_TEXT}' or {x} rlike '{DATE_TEXT}' then try_cast({x} as timestamp_ntz) end"
    return no_value(native)


def _to_int(x: str, src: T.DataType, kind: str, out: T.DataType) -> str:
    if isinstance(src, T.BooleanType):
        return f"cast(cast({x} as int) as {type_sql(out)})"
    if isinstance(src, T.StringType):
        value = f"case when {x} rlike '{INT_TEXT}' then try_cast(substring_index({x}, '.', 1) as bigint) end"
    elif isinstance(src, _NUMERIC):
        value = f"try_cast({x} as bigint)"
    else:
        return no_value(out)
    if kind == "int64":
        return value
    if kind == "uint64":
        # values that no column can hold stop the job, whatever the policy for bad values
        whole = f"substring_index({x}, '.', 1)" if isinstance(src, T.StringType) else x
        told = f"raise_error(concat('uint64 value beyond the signed 64-bit range: ', cast({x} as string)))"
        beyond = f"try_cast({whole} as decimal(38,0)) > {INT_RANGE[kind][1]}"
        return f"case when {beyond} then cast({told} as bigint) when {value} >= 0 then {value} end"
    low, high = INT_RANGE[kind]
    return f"try_cast(case when {value} between {low} and {high} then {value} end as {type_sql(out)})"


def _to_float(x: str, src: T.DataType, out: T.DataType) -> str:
    number = f"try_cast({x} as {type_sql(out)})"
    if isinstance(src, T.StringType):
        finite = f"case when abs({number}) <> {type_sql(out)}('Infinity') then {number} end"
        return f"case when {x} rlike '{FLOAT_TEXT}' then {finite} when {x} rlike '{FLOAT_WORD}' then {number} end"
    if isinstance(src, T.BooleanType):
        return f"cast(cast({x} as int) as {type_sql(out)})"
    return number if isinstance(src, _NUMERIC) else no_value(out)


def _to_bool(x: str, src: T.DataType) -> str:
    if isinstance(src, T.BooleanType):
        return x
    if isinstance(src, T.StringType):
        return f"case when {x} in {TRUE_WORDS} then true when {x} in {FALSE_WORDS} then false end"
    return f"{x} <> 0" if isinstance(src, _NUMERIC) else no_value(T.BooleanType())


def _to_date(x: str, src: T.DataType) -> str:
    if isinstance(src, T.DateType):
        return x
    if isinstance(src, T.TimestampNTZType):
        return f"cast({x} as date)"
    if isinstance(src, T.TimestampType):
        return f"date_from_unix_date(cast(floor(unix_seconds({x}) / 86400) as int))"
    if isinstance(src, _WHOLE):
        return f"date_from_unix_date(try_cast({x} as int))"
    if isinstance(src, T.StringType):
        return f"case when {x} rlike '{DATE_TEXT}' then try_cast({x} as date) end"
    return no_value(T.DateType())


def _to_timestamp(x: str, src: T.DataType) -> str:
    if isinstance(src, T.TimestampType):
        return x
    if isinstance(src, T.TimestampNTZType):
        spark = SparkSession.getActiveSession()
        if spark is not None and is_utc(spark):
            return f"cast({x} as timestamp)"
        return f"try_cast(concat(cast({x} as string), 'Z') as timestamp)"
    if isinstance(src, T.DateType):
        return f"timestamp_seconds(unix_date({x}) * 86400L)"
    if isinstance(src, _WHOLE):
        return f"timestamp_millis(case when {x} between -{MAX_MILLIS} and {MAX_MILLIS} then cast({x} as bigint) end)"
    if isinstance(src, T.StringType):
        utc = (
            f"case when {x} rlike '{CLOCK_TEXT}' then concat({x}, 'Z') "
            f"when {x} rlike '{DATE_TEXT}' then concat({x}, ' 00:00:00Z') when {x} rlike '{ZONED_TEXT}' then {x} end"
        )
        return f"try_cast({utc} as timestamp)"
    return no_value(T.TimestampType())


def number_text(x: str) -> str:
    """A float or double as plain decimal text: no exponent, no ``.0``, ``+Inf`` / ``-Inf`` / ``NaN``."""
    text = f"cast({x} as string)"
    plain = f"case when endswith({text}, '.0') then substr({text}, 1, length({text}) - 2) else {text} end"
    # the other forms are rare; as a lambda they stay out of the compiled row loop
    sign = "if(startswith(t, '-'), '-', '')"
    power = "try_cast(regexp_extract(t, 'E(-?[0-9]+)$', 1) as int)"
    frac = "regexp_replace(regexp_extract(t, '[.]([0-9]+)', 1), '0+$', '')"
    digits = f"concat(regexp_extract(t, '^-?([0-9]+)', 1), {frac})"
    large = (
        f"if(length({frac}) <= {power}, concat({digits}, repeat('0', {power} - length({frac}))), "
        f"concat(substr({digits}, 1, {power} + 1), '.', substr({digits}, {power} + 2)))"
    )
    small = f"concat('0.', repeat('0', -{power} - 1), {digits})"
    spelled = (
        f"case t when 'Infinity' then '+Inf' when '-Infinity' then '-Inf' when 'NaN' then t "
        f"else concat({sign}, if({power} >= 0, {large}, {small})) end"
    )
    unusual = f"get(transform(array({text}), t -> {spelled}), 0)"
    return f"case when abs({x}) >= 1e-3 and abs({x}) < 1e7 or {x} = 0 then {plain} when {x} is not null then {unusual} end"


def to_text(x: str, src: T.DataType) -> str:
    if isinstance(src, T.StringType):
        return x
    if isinstance(src, (T.FloatType, T.DoubleType)):
        return number_text(x)
    if isinstance(src, (*_NESTED, T.VariantType)):
        return to_json_text(x, src)
    return f"cast({x} as string)"


def to_json_text(x: str, src: T.DataType) -> str:
    """JSON encoding of any value; null members are kept, a null value stays null."""
    if isinstance(src, _NESTED):
        return f"to_json({x}, map('ignoreNullFields', 'false'))"
    if isinstance(src, T.VariantType):
        return f"to_json({x})"
    if isinstance(src, (*_WHOLE, T.BooleanType)):
        return f"cast({x} as string)"
    wrapped = f"to_json(array({x}), map('ignoreNullFields', 'false'))"
    return f"case when {x} is not null then substr({wrapped}, 2, length({wrapped}) - 2) end"


def to_variant(x: str, src: T.DataType) -> str:
    """Any value as a variant; maps whose keys are not text go through their JSON text."""
    if isinstance(src, T.VariantType):
        return x
    objects = _objects(src)
    if any(isinstance(o, T.MapType) and not isinstance(o.keyType, T.StringType) for o in objects):
        return f"try_parse_json({to_json_text(x, src)})"
    return f"to_variant_object({x})" if objects else f"cast({x} as variant)"


def _objects(dtype: T.DataType) -> list[T.DataType]:
    """The maps and structs in a type."""
    if isinstance(dtype, T.MapType):
        return [dtype, *_objects(dtype.valueType)]
    if isinstance(dtype, T.ArrayType):
        return _objects(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return [dtype, *[o for f in dtype.fields for o in _objects(f.dataType)]]
    return []


def _from_variant(x: str, target: ColSchema) -> str:
    """A variant is converted by the rule of the type it holds.

    Few branches per column: tables are wide, and the row loop must stay small enough to be compiled.
    """
    out = stored_type(target)
    kind = target.data_type
    held = f"schema_of_variant({x})"

    def get(dtype: T.DataType) -> str:
        return f"try_variant_get({x}, '$', '{type_sql(dtype)}')"

    def rule(dtype: T.DataType) -> str:
        return convert(get(dtype), dtype, target)

    text = T.StringType()
    if kind == "any":
        return f"case when not is_variant_null({x}) then to_json({x}) end"
    if kind == "bytes":
        return f"case when {held} = 'BINARY' then {get(out)} end"
    if isinstance(out, T.StringType):
        nested = f"startswith({held}, 'OBJECT') or startswith({held}, 'ARRAY')"
        number, short = number_text(get(T.DoubleType())), number_text(get(T.FloatType()))
        return (
            f"case when {held} = 'STRING' then {get(text)} when {held} = 'DOUBLE' then {number} when {held} = 'FLOAT' then {short} "
            f"when {nested} then to_json({x}) else {get(text)} end"
        )
    if kind in _TIME_KINDS:
        held_rules = {
            "STRING": text,
            "TIMESTAMP_NTZ": T.TimestampNTZType(),
            "TIMESTAMP": T.TimestampType(),
            "DATE": T.DateType(),
            "BIGINT": T.LongType(),
        }
        return "case " + held + "".join(f" when '{n}' then {rule(t)}" for n, t in held_rules.items()) + " end"
    if kind == "boolean":
        return (
            f"case when {held} = 'STRING' then {rule(text)} when {held} = 'BOOLEAN' then {get(out)} "
            f"when {held} not in ({_TIMES}) then {get(T.DoubleType())} <> 0 end"
        )
    number = rule(T.LongType()) if kind in INT_RANGE else get(out)
    return f"case when {held} = 'STRING' then {rule(text)} when {held} not in ({_TIMES}) then {number} end"


def is_present(x: str, src: T.DataType) -> str:
    """Whether there is a value to convert: not null and, for a variant, not a JSON null."""
    if isinstance(src, T.VariantType):
        return f"({x} is not null and not is_variant_null({x}))"
    return f"({x} is not null)"


def zero_value(target: ColSchema) -> str:
    """The value a failed conversion leaves under ``on_error="default"``."""
    out = stored_type(target)
    kind = target.data_type
    if target.native is not None or kind == "bytes":
        return no_value(out)
    if kind == "boolean":
        return "false"
    if kind == "date":
        return "date_from_unix_date(0)"
    if kind in _TIME_KINDS:
        return "timestamp_seconds(0)"
    if kind in INT_RANGE or kind in _FLOAT_KINDS:
        return f"cast(0 as {type_sql(out)})"
    return "''"


def with_policy(x: str, src: T.DataType, target: ColSchema, on_error: str | None) -> str:
    """``convert`` with a policy for failures; without one: fail if required, else null."""
    value = convert(x, src, target)
    policy = on_error or ("fail" if target.required else "null")
    if policy not in ("null", "default", "fail"):
        raise ValueError(f"unknown on_error policy {policy!r}")
    if policy == "null" or src == stored_type(target):
        return value
    if policy == "default":
        return f"coalesce({value}, case when {is_present(x, src)} then {zero_value(target)} end)"
    told = text_sql(f"column {target.name}: no {target.data_type} form of ")
    failure = f"cast(raise_error(concat({told}, coalesce({to_text(x, src)}, 'null'))) as {type_sql(stored_type(target))})"
    return f"coalesce({value}, case when {is_present(x, src)} then {failure} end)"
