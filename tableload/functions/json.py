"""JSON documents: raw sub-documents and arrays, and their elements as numbers or text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def _path(field: str) -> str:
    return f"$['{field}']"


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def json_raw(document: Column, field: str) -> Column:
    """JSON text of one field, keys in document order; null where the field is missing.

    ``get_json_object`` strips the quotes of a string, which raw text keeps.
    """
    text = F.get_json_object(document, _path(field))
    quoted = F.try_parse_json(document)
    value = F.try_variant_get(quoted, _path(field), "variant")
    scalar_text = ~(text.startswith("{") | text.startswith("["))
    return F.when(scalar_text & _is_string(value), F.to_json(value)).otherwise(text)


def _field_as(document: Column, field: str, dtype: T.DataType) -> Column:
    """One field of a document as a Spark type, found in one pass; null where the document does not fit it."""
    return F.from_json(document, T.StructType([T.StructField(field, dtype)])).getField(field)


def json_array_raw(document: Column, field: str) -> Column:
    """Elements of an array field as JSON text; null where the field is not an array.

    Element text comes without the quotes of a string. Where every element begins with a bracket and the
    document has no string that does, no element is a string and the text stands as it is.
    """
    no_such_text = ~F.contains(document, F.lit('"{')) & ~F.contains(document, F.lit('"['))
    values = F.try_variant_get(F.try_parse_json(document), _path(field), "array<variant>")

    def quoted(elements: Column) -> Column:
        return F.zip_with(
            elements, values, lambda t, v: F.when(_is_string(v) | F.is_variant_null(v), F.to_json(v)).otherwise(t)
        )

    def as_they_are(elements: Column) -> Column:
        return no_such_text & F.forall(
            elements, lambda x: F.coalesce(x.startswith("{") | x.startswith("["), F.lit(False))
        )

    # bound by a lambda, the parsed elements are not computed once per use
    elements = F.array(_field_as(document, field, T.ArrayType(T.StringType())))
    return F.get(F.transform(elements, lambda e: F.when(as_they_are(e), e).otherwise(quoted(e))), F.lit(0))


def _members(document: Column, field: str, key: str) -> Column:
    """``key`` of each element of an array field as text: in one pass if all elements are objects."""
    objects = T.ArrayType(T.StructType([T.StructField(key, T.StringType())]))
    elements = _field_as(document, field, T.ArrayType(T.StringType()))
    return F.coalesce(
        _field_as(document, field, objects).getField(key),
        F.transform(elements, lambda x: F.get_json_object(x, _path(key))),
    )


def json_array_float(document: Column, field: str, key: str) -> Column:
    """``key`` of each element of an array field as a double; null where missing or not a number."""
    return F.transform(_members(document, field, key), lambda x: x.try_cast("double"))


def json_array_string(document: Column, field: str, key: str) -> Column:
    return _members(document, field, key)


def assume_not_null(col: Column) -> Column:
    """A missing document counts as empty text, so that its row stays."""
    return F.coalesce(col, F.lit(""))
