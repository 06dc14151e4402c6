"""Partition transforms: the value a row is stored under."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

# Transforms, and the suffix of the column they make.
SUFFIX = {
    "identity": "",
    "years": "_year",
    "months": "_month",
    "days": "_day",
    "hours": "_hour",
    "truncate": "_trunc",
    "bucket": "_bucket",
}
MONOTONIC = ("identity", "years", "months", "days", "hours", "truncate")
PREFIX = "_p_"

_SPEC = re.compile(r"^(?:(\w+)\()?(?:(\d+)\s*,\s*)?([^,()]+?)\)?$")


@dataclass(frozen=True)
class Transform:
    """``years(dt)``, ``bucket(16, number)``, ``truncate(1, letter)`` or a bare column name."""

    kind: str
    source: str
    width: int | None = None

    @classmethod
    def parse(cls, spec: str) -> Transform:
        match = _SPEC.match(spec.strip())
        kind = (match.group(1) or "identity") if match else ""
        if kind not in SUFFIX:
            raise ValueError(f"unknown partition transform {spec!r}")
        width = int(match.group(2)) if match.group(2) else None
        if kind in ("truncate", "bucket") and not width:
            raise ValueError(f"{kind} needs a width: {spec!r}")
        return cls(kind, match.group(3).strip(), width)

    @property
    def column(self) -> str:
        return f"{PREFIX}{self.source}{SUFFIX[self.kind]}"

    def result_type(self, source: T.DataType) -> T.DataType:
        if self.kind == "identity" or self.kind == "truncate":
            return source
        return T.IntegerType()

    def value(self, col: Column, dtype: T.DataType) -> Column:
        if self.kind == "identity":
            return col
        if isinstance(dtype, T.TimestampType) and self.kind in ("years", "months", "days"):
            # of the day in UTC, whatever the session's zone
            col = F.date_from_unix_date(F.floor(F.unix_seconds(col) / F.lit(86400)).cast("int"))
        if self.kind == "years":
            return F.year(col) - 1970
        if self.kind == "months":
            return (F.year(col) - 1970) * 12 + F.month(col) - 1
        if self.kind == "days":
            return F.unix_date(col.cast("date"))
        if self.kind == "hours":
            if isinstance(dtype, T.TimestampNTZType):
                return F.unix_date(col.cast("date")) * 24 + F.hour(col)
            return F.floor(F.unix_seconds(col) / F.lit(3600)).cast("int")
        if self.kind == "truncate":
            if isinstance(dtype, T.StringType):
                return F.substring(col, 1, self.width)
            return (col - F.pmod(col, F.lit(self.width))).cast(dtype)
        return F.pmod(F.hash(col), F.lit(self.width))

    def between(self, low: object, high: object, dtype: T.DataType) -> Column | None:
        """Partition filter implied by ``low <= source <= high``; none where the transform has no order."""
        column = F.col(f"`{self.column}`")
        if self.kind in MONOTONIC:
            bound = column.between(
                self.value(F.lit(low).cast(dtype), dtype), self.value(F.lit(high).cast(dtype), dtype)
            )
            # the empty text comes back from a folder's name as null
            return bound | column.isNull() if isinstance(dtype, T.StringType) and low == "" else bound
        if low == high:
            return column == self.value(F.lit(low).cast(dtype), dtype)
        return None
