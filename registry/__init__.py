"""The package's queries over the given tables, each with SQL that gives the same rows."""

from registry import base, columns, content, loads, reads, streams

QUERIES = base.QUERIES
ORACLE = base.ORACLE

__all__ = ["ORACLE", "QUERIES", "columns", "content", "loads", "reads", "streams"]
