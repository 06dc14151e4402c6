"""A user's SELECT over the tables of a load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tableload.functions.types import ColSchema, from_struct_type, with_keys

SOURCE = "{source}"


def sql_transform(df: DataFrame, query: str) -> DataFrame:
    """Run ``query`` over ``df``; the query names its input ``{source}``."""
    if SOURCE not in query:
        raise ValueError(f"the query must read from {SOURCE}")
    return df.sparkSession.sql(query, source=df)


def transform_tables(
    tables: Mapping[tuple[str, str], DataFrame], query: str, include: Iterable[str] | None = None
) -> dict[tuple[str, str], DataFrame]:
    """The query applied to the included tables only (``namespace.name``; no list means all)."""
    listed = None if include is None else set(include)
    return {
        key: sql_transform(df, query) if listed is None or ".".join(key) in listed else df
        for key, df in tables.items()
    }


@dataclass(frozen=True)
class Transform:
    """A SELECT for the rows of some tables on their way from a feed into the warehouse.

    ``include`` lists the tables it is for (``namespace.name``; None: all). The result's columns are the table's: their
    types are derived from it, ``keys`` names its identifier columns. ``into`` is another name for the table; several
    tables may not go into one.
    """

    query: str
    include: tuple[str, ...] | None = None
    keys: tuple[str, ...] = ()
    into: tuple[str, str] | None = None

    def applies(self, key: tuple[str, str]) -> bool:
        return self.include is None or ".".join(key) in self.include

    def run(self, rows: DataFrame) -> tuple[DataFrame, list[ColSchema]]:
        out = sql_transform(rows, self.query)
        return out, with_keys(from_struct_type(out.schema), self.keys)


def transform_of(transforms: Sequence[Transform], key: tuple[str, str]) -> Transform | None:
    """The transform of a table; the first one that is for it."""
    return next((t for t in transforms if t.applies(key)), None)
