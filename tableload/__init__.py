"""Tables and append-only streams into versioned Parquet tables, and back, as Spark jobs."""

from tableload.functions.types import ColSchema, from_struct_type, to_struct_type, with_keys
from tableload.operators.conform import conform, conform_report, describe_schema, required_check
from tableload.operators.feed import route, split_events, table_to_changes
from tableload.operators.verify import canon_compare, load_stats, reconcile
from tableload.plans.table import Table, TableNotFound, VersionNotFound
from tableload.plans.warehouse import Warehouse
from tableload.session import build_session, scratch_dir
from tableload.streaming.append import stream_append, stream_table, transfer

__all__ = [
    "ColSchema",
    "Table",
    "TableNotFound",
    "VersionNotFound",
    "Warehouse",
    "build_session",
    "canon_compare",
    "conform",
    "conform_report",
    "describe_schema",
    "from_struct_type",
    "load_stats",
    "reconcile",
    "required_check",
    "route",
    "scratch_dir",
    "split_events",
    "stream_append",
    "stream_table",
    "table_to_changes",
    "to_struct_type",
    "transfer",
    "with_keys",
]
