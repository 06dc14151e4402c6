"""Table identifiers and namespaces as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def id_namespace(parts: Column) -> Column:
    """All parts of an identifier but the last, joined with a dot ('' for a one-part name)."""
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ".")


def id_name(parts: Column) -> Column:
    return F.try_element_at(parts, F.lit(-1))


def split_id(table_id: Column) -> tuple[Column, Column]:
    """``a.b.t`` -> namespace ``a.b`` and name ``t``."""
    parts = F.split(table_id, r"\.")
    return id_namespace(parts), id_name(parts)


def join_id(namespace: Column, name: Column) -> Column:
    """Inverse of ``split_id``: no leading dot for an empty namespace."""
    return F.when(F.coalesce(namespace, F.lit("")) == "", name).otherwise(F.concat_ws(".", namespace, name))


def parse_id(table_id: str) -> tuple[str, str]:
    namespace, _, name = table_id.rpartition(".")
    return namespace, name


def default_namespace(namespace: Column, default: str) -> Column:
    return F.coalesce(F.nullif(namespace, F.lit("")), F.lit(default))
