"""A table of versioned Parquet loads: publish, read, delete, list."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime, timezone
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableload.functions.layout import Transform
from tableload.functions.types import ColSchema, from_struct_type, identifier_columns, stored_name, to_struct_type
from tableload.operators.conform import conform, quoted, require_values
from tableload.operators.feed import table_to_changes
from tableload.operators.verify import observed
from tableload.plans.ledger import (
    LOADS,
    ROLLED_UP,
    Entry,
    claim,
    current_entries,
    live_entries,
    ledger_frame,
    loaded_rows,
    publish,
    publish_together,
    read_entries,
    segment,
    table_folder,
    unused_id,
    visible_entries,
)

LOAD_COLUMN = "_load_id"
PART_COLUMN = "_load_part"
# Properties of registered files: their folders, the moment before which all of them were written, and their names' digest.
REGISTERED = "registered_paths"
REGISTERED_BEFORE = "registered_before"
REGISTERED_FILES = "registered_files"

# Properties of a measured load.
MEASURED = ("measured_bytes", "measured_millis")

# Files with deleted rows that the driver tells the scan by name; of more, the rows are told apart by a join.
TOUCHED_FILES = 10_000
FILE_COLUMN = "_file"
POSITION_COLUMN = "_pos"

# Deleted positions as bitmaps: rows of a file that one covers (as Spark's bitmap functions have it), and the most bytes that
# are broadcast of them: those of some 450 million rows in touched files.
BLOCK_ROWS = 1 << 15
BITMAP_BYTES = 64 << 20

DELETE_SCHEMA = T.StructType([T.StructField(FILE_COLUMN, T.StringType()), T.StructField(POSITION_COLUMN, T.LongType())])


class TableNotFound(ValueError):
    """The table was never created, or was dropped."""


class VersionNotFound(ValueError):
    """No such version, tag or moment in the table's ledger."""


class Table:
    def __init__(self, spark: SparkSession, root: str, namespace: str, name: str) -> None:
        self.spark = spark
        self.root = root
        self.namespace = namespace
        self.name = name

    # -- ledger -------------------------------------------------------------------------------------

    def entries(self) -> list[Entry]:
        return read_entries(self.spark, self.root, self.namespace, self.name)

    def exists(self) -> bool:
        return bool(live_entries(self.entries()))

    def _live(self, up_to: int | None = None) -> list[Entry]:
        life = live_entries(self.entries(), up_to)
        if not life:
            raise TableNotFound(f"no table {self.namespace}.{self.name}")
        return life

    def versions(self) -> DataFrame:
        """Published versions in order: sequence number, load id, operation, rows, properties, time."""
        return ledger_frame(self.spark, self.root, self.namespace, self.name).select(
            "seq", "load_id", "op", "rows", "props", "published_at"
        )

    def _publish(
        self,
        entries: list[Entry],
        op: str,
        load_id: str,
        rows: int = 0,
        path: str = "",
        props: Mapping[str, str] | None = None,
        schema: T.StructType | None = None,
        partition_by: Sequence[str] | None = None,
    ) -> Entry:
        life = live_entries(entries)
        if schema is None and life:
            schema = life[-1].schema
        if partition_by is None:
            partition_by = life[-1].partitions if life else []
        entry = Entry(
            self.namespace,
            self.name,
            claim(self.spark, self.root, self.namespace, self.name, max((e.seq for e in entries), default=0) + 1),
            load_id,
            op,
            rows,
            0,
            path,
            dict(props or {}),
            None,
            (schema or T.StructType()).json(),
            json.dumps(list(partition_by)),
        )
        entry = replace(entry, total_rows=loaded_rows(entries + [entry]))
        publish(self.spark, self.root, entry, unused_id(entries, load_id))
        return entry

    def _published(self, entries: list[Entry], load_id: str) -> Entry | None:
        """The entry of a load id since the table's rows last began anew."""
        return next((e for e in current_entries(entries) if e.load_id == load_id), None)

    def has_load(self, load_id: str) -> bool:
        """Whether the load is published, since the table's rows last began anew."""
        return self._published(self.entries(), load_id) is not None

    def ensure(
        self, cols: Sequence[ColSchema], partition_by: Sequence[str] = (), props: Mapping[str, str] | None = None
    ) -> bool:
        """Create the table unless it is there; an existing one is left as it is. True if created."""
        entries = self.entries()
        if live_entries(entries):
            return False
        schema = to_struct_type(cols)
        for spec in partition_by:
            if Transform.parse(spec).source not in schema.names:
                raise ValueError(f"partition column of {spec!r} is not in the schema")
        self._publish(entries, "create", _new_id("create"), props=props, schema=schema, partition_by=partition_by)
        return True

    def drop(self, load_id: str | None = None) -> bool:
        """End the table's life; no error if it is absent. An id that was published is not acted on again."""
        entries = self.entries()
        if not live_entries(entries) or any(e.load_id == load_id for e in entries):
            return False
        self._publish(entries, "drop", load_id or _new_id("drop"))
        return True

    def truncate(self, cols: Sequence[ColSchema] | None = None, load_id: str | None = None) -> bool:
        """Hide all rows and take on the given schema; an absent table is not created. Ids as for ``drop``."""
        entries = self.entries()
        if not live_entries(entries) or any(e.load_id == load_id for e in entries):
            return False
        self._publish(entries, "truncate", load_id or _new_id("truncate"), schema=to_struct_type(cols) if cols else None)
        return True

    def add_columns(self, cols: Sequence[ColSchema]) -> T.StructType:
        """Add nullable columns at the end; rows written before hold null in them."""
        entries = self.entries()
        life = self._live()
        known = life[-1].schema
        new = [c for c in cols if stored_name(c.name) not in known.names]
        if any(c.required for c in new):
            raise ValueError("a column added to a table cannot be required")
        schema = T.StructType(known.fields + to_struct_type(new).fields)
        if new:
            self._publish(entries, "alter", _new_id("alter"), schema=schema)
        return schema

    def tag(self, name: str, version: int | None = None) -> None:
        """Name a version."""
        life = self._live()
        seq = life[-1].seq if version is None else self._check_version(self.entries(), version)
        self._publish(self.entries(), "tag", f"tag-{name}", props={"tag": name, "seq": str(seq)})

    def branch(self, name: str, version: int | None = None) -> Table:
        """A table of its own that begins with this one's rows at a version; no data is copied."""
        fork = Table(self.spark, self.root, self.namespace, f"{self.name}@{name}")
        if fork.exists():
            raise ValueError(f"branch {name} is there already")
        publish_together(self.spark, self.root, [replace(e, table=fork.name) for e in self._live(version)])
        return fork

    # -- schema -------------------------------------------------------------------------------------

    def schema(self, version: int | None = None) -> T.StructType:
        return self._live(version)[-1].schema

    def columns(self) -> list[ColSchema]:
        return from_struct_type(self.schema())

    def identifier_columns(self) -> list[str]:
        return identifier_columns(self.schema())

    # -- loads --------------------------------------------------------------------------------------

    def load(
        self,
        df: DataFrame,
        cols: Sequence[ColSchema] | None = None,
        load_id: str | None = None,
        mode: str = "append",
        props: Mapping[str, str] | None = None,
        on_error: str | None = None,
        nested: str = "json",
        load_part: Column | None = None,
        partition_by: Sequence[str] | None = None,
        max_records_per_file: int | None = None,
        rebalance: bool = False,
        measure: bool = False,
    ) -> Entry:
        """Stage the rows as a new load, then publish it. A load id that is already published is skipped.

        ``measure`` notes value bytes and time of the load in its properties, for ``metrics``; the bytes are observed while
        the rows are written (a task that is retried may count twice).

        ``rebalance`` shuffles the rows into evenly sized files, for sources of many small or uneven partitions.

        ``mode="replace"`` hides everything before it; readers see the old rows until the load is published.
        """
        if mode not in ("append", "replace"):
            raise ValueError(f"unknown load mode {mode!r}")
        entries = self.entries()
        load_id = load_id or _new_id(mode)
        if done := self._published(entries, load_id):
            return done
        life = live_entries(entries)
        if life and mode == "append":
            schema, specs = life[-1].schema, life[-1].partitions
            cols = from_struct_type(schema)
        else:
            schema, specs = None, list(partition_by if partition_by is not None else life[-1].partitions if life else [])
            cols = cols or from_struct_type(df.schema)
        extra = []
        if load_part is not None:
            df = df.withColumn(PART_COLUMN, load_part.cast("string"))
            extra = [PART_COLUMN]
        rows = require_values(conform(df, cols, on_error, nested, extra), cols)
        if schema is None:
            schema = T.StructType(
                [T.StructField(f.name, rows.schema[f.name].dataType, True, f.metadata) for f in to_struct_type(cols).fields]
            )
        path = self._load_path(entries, load_id)
        began = time.monotonic()
        rows, seen = observed(rows, f"load-{uuid.uuid4().hex}", schema.names) if measure else (rows, None)
        written = self._write(rows, schema, specs, path, max_records_per_file, rebalance)
        if seen is not None:
            took = round(1000 * (time.monotonic() - began))
            props = {**(props or {}), MEASURED[0]: str(seen.get.get("bytes") or 0), MEASURED[1]: str(took)}
        return self._publish(entries, mode, load_id, written, path, props, schema, specs)

    def metrics(self) -> DataFrame:
        """Rows, value bytes and milliseconds of each load that was measured, such as every batch of a stream, in order of time."""
        loads = ledger_frame(self.spark, self.root, self.namespace, self.name).filter(F.col("op").isin("append", "replace"))
        noted = [F.try_element_at("props", F.lit(name)).cast("bigint") for name in MEASURED]
        return loads.select("seq", "load_id", "rows", noted[0].alias("bytes"), noted[1].alias("millis"), "published_at").filter("bytes is not null")

    def _load_path(self, entries: list[Entry], load_id: str) -> str:
        return f"{table_folder(self.root, 'data', self.namespace, self.name)}/{segment(LOAD_COLUMN, unused_id(entries, load_id))}"

    def stage_part(self, df: DataFrame, load_id: str, part: str, on_error: str | None = None, nested: str = "json") -> int:
        """Write one part of a load without publishing it; the table must exist. Rows of the part.

        Parts are written by any number of workers at once. Writing a part again replaces it.
        """
        entries = self.entries()
        life = self._live()
        if self._published(entries, load_id):
            raise ValueError(f"load {load_id} is published already")
        cols = from_struct_type(life[-1].schema)
        rows = df.withColumn(PART_COLUMN, F.lit(part))
        rows = require_values(conform(rows, cols, on_error, nested, [PART_COLUMN]), cols)
        path = f"{self._load_path(entries, load_id)}/{quote('part-' + part, safe='')}"
        return self._write(rows, life[-1].schema, life[-1].partitions, path)

    def publish_parts(self, load_id: str, parts: Sequence[str], mode: str = "append", props: Mapping[str, str] | None = None) -> Entry:
        """Make the staged parts of a load visible, all at once; every one of ``parts`` must be there, and no other."""
        entries = self.entries()
        if done := self._published(entries, load_id):
            return done
        life = self._live()
        path = self._load_path(entries, load_id)
        rows = self.spark.read.schema(T.StructType([T.StructField(PART_COLUMN, T.StringType())])).option("recursiveFileLookup", "true")
        staged = {r[0]: r[1] for r in rows.parquet(path).groupBy(PART_COLUMN).count().collect()}  # one row per part
        folders = {p: f"{path}/{quote('part-' + p, safe='')}" for p in parts}
        missing = [p for p in parts if p not in staged and not _is_there(self.spark, folders[p])]
        if missing or set(staged) - set(parts):
            raise ValueError(f"load {load_id}: parts {missing} are not staged, parts {sorted(set(staged) - set(parts))} are not asked for")
        return self._publish(entries, mode, load_id, sum(staged.values()), path, props, life[-1].schema, life[-1].partitions)

    def _write(
        self,
        rows: DataFrame,
        schema: T.StructType,
        specs: Sequence[str],
        path: str,
        max_records: int | None = None,
        rebalance: bool = False,
    ) -> int:
        transforms = [Transform.parse(s) for s in specs]
        for t in transforms:
            rows = rows.withColumn(t.column, t.value(quoted(t.source), schema[t.source].dataType))
        if transforms:
            # few files per partition value; the adaptive planner splits the values that hold many rows
            rows = rows.hint("rebalance", *[quoted(t.column) for t in transforms])
        elif rebalance:
            rows = rows.hint("rebalance")
        writer = rows.write.mode("overwrite")
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        if transforms:
            writer = writer.partitionBy(*[t.column for t in transforms])
        writer.parquet(path)
        return self._count_rows(path)

    def _count_rows(self, path: str) -> int:
        """Rows of a staged folder, from the file footers: no column is read."""
        return self.spark.read.schema("_none int").option("recursiveFileLookup", "true").parquet(path).count()

    def register(
        self, paths: Sequence[str], cols: Sequence[ColSchema] | None = None, load_id: str | None = None,
        props: Mapping[str, str] | None = None,
    ) -> Entry:
        """Make existing Parquet files part of the table without copying them.

        Files that are part of the table already are refused, as is a column whose type does not match.
        The list of files is kept as a table of its own, so later files in the same folder stay unseen.
        """
        entries = self.entries()
        load_id = load_id or _new_id("register")
        if done := self._published(entries, load_id):
            return done
        life = live_entries(entries)
        # every footer is read, by a job: files that do not go together are refused here, not at a later read
        frames = [self.spark.read.option("mergeSchema", "true").parquet(path) for path in paths]
        found = frames[0].schema
        cols = cols or from_struct_type(life[-1].schema if life else found)
        schema = life[-1].schema if life else to_struct_type(cols)
        for frame in frames:
            for field in schema.fields:
                if field.name in frame.columns and frame.schema[field.name].dataType != field.dataType:
                    raise ValueError(
                        f"column {field.name} is {frame.schema[field.name].dataType.simpleString()} in the files, "
                        f"{field.dataType.simpleString()} in the table"
                    )
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        found_files = _union([reader.load(path).select(F.col("_metadata.file_path").alias(FILE_COLUMN), "modificationTime") for path in paths])
        files = found_files.select(FILE_COLUMN)
        twice = files.groupBy(FILE_COLUMN).count().filter("count > 1").select(FILE_COLUMN)
        known = [e.path for e in current_entries(entries) if e.op == "register"]
        if known:
            twice = twice.unionByName(files.join(self._file_lists(known), FILE_COLUMN, "left_semi"))
        if repeated := twice.take(1):
            raise ValueError(f"{repeated[0][0]} is part of the table already")
        path = f"{table_folder(self.root, 'files', self.namespace, self.name)}/{segment(LOAD_COLUMN, unused_id(entries, load_id))}"
        files.write.mode("overwrite").parquet(path)
        rows = sum(frame.count() for frame in frames)
        last = found_files.agg(F.unix_seconds(F.max("modificationTime"))).first()[0]
        before = datetime.fromtimestamp(last + 1, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        listed = _listed_files([self._scan_before(path, schema, before) for path in paths])
        props = {**(props or {}), REGISTERED: json.dumps(list(paths)), REGISTERED_BEFORE: before, REGISTERED_FILES: listed}
        return self._publish(entries, "register", load_id, rows, path, props, schema)

    def _file_lists(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(f"{FILE_COLUMN} string").parquet(*paths)

    def _scan_before(self, path: str, schema: T.StructType, before: str) -> DataFrame:
        return self.spark.read.schema(schema).option("modifiedBefore", before).option("timeZone", "UTC").parquet(path)

    def _registered(self, entry: Entry, schema: T.StructType, positions: bool) -> DataFrame:
        """Rows of registered files.

        The scan itself leaves out files written after the registration. If what it lists is what was registered, as
        nearly always, that is all; if files were moved in or taken away, a join with the recorded list decides.
        """
        paths = json.loads(entry.props[REGISTERED])
        frames = [self._scan_before(path, schema, entry.props[REGISTERED_BEFORE]) for path in paths]
        same = _listed_files(frames) == entry.props[REGISTERED_FILES]
        frames = frames if same else [self.spark.read.schema(schema).parquet(path) for path in paths]
        if positions or not same:
            frames = [rows.withColumn(FILE_COLUMN, F.col("_metadata.file_path")) for rows in frames]
        if positions:
            frames = [rows.withColumn(POSITION_COLUMN, F.col("_metadata.row_index")) for rows in frames]
        if same:
            return _union(frames)
        files = self._file_lists([entry.path])
        return _union([rows.join(files, FILE_COLUMN, "left_semi") for rows in frames])

    def delete_where(self, condition: Column | str, load_id: str | None = None) -> Entry:
        """Record the position of every matching row; data files stay as they are."""
        entries = self.entries()
        load_id = load_id or _new_id("delete")
        if done := self._published(entries, load_id):
            return done
        self._live()
        path = f"{table_folder(self.root, 'deletes', self.namespace, self.name)}/{segment(LOAD_COLUMN, load_id)}"
        matches = self.read(positions=True).filter(condition).select(FILE_COLUMN, POSITION_COLUMN)
        matches.write.mode("overwrite").parquet(path)
        return self._publish(entries, "delete", load_id, self._count_rows(path), path)

    def compact(
        self, first: int = 1, last: int | None = None, load_id: str | None = None, max_records_per_file: int | None = None
    ) -> Entry | None:
        """Rewrite the loads of versions ``first`` to ``last``, deletes applied, as one load that stands for them.

        A table that is appended to all day is rolled up stretch by stretch; its older rows are not read again.
        """
        entries = self.entries()
        load_id = load_id or _new_id("rollup")
        if done := self._published(entries, load_id):
            return done
        shown = visible_entries(self._live())
        last = max(e.seq for e in shown) if last is None else last
        chosen = [e for e in shown if e.op in LOADS and first <= e.span[0] and e.span[1] <= last]
        if not chosen:
            return None
        schema, specs = shown[-1].schema, shown[-1].partitions
        rows = self._rows(chosen, [e for e in shown if e.op == "delete" and e.rows], schema, specs, False)
        path = f"{table_folder(self.root, 'data', self.namespace, self.name)}/{segment(LOAD_COLUMN, load_id)}"
        rows = rows.select(*[quoted(n) for n in schema.names])
        written = self._write(rows, schema, specs, path, max_records_per_file, rebalance=True)
        props = {
            ROLLED_UP[0]: str(min(e.span[0] for e in chosen)),
            ROLLED_UP[1]: str(max(e.span[1] for e in chosen)),
        }
        return self._publish(entries, "rollup", load_id, written, path, props, schema, specs)

    def manifest(self, load_ids: Sequence[str] | None = None) -> DataFrame:
        """Rows per load, part and file of the visible loads; reads one narrow column."""
        loads = [e for e in visible_entries(self.entries()) if e.op in LOADS and e.op != "register" and e.rows]
        if load_ids is not None:
            loads = [e for e in loads if e.load_id in load_ids]
        schema = T.StructType([T.StructField(PART_COLUMN, T.StringType())])
        if not loads:
            return self.spark.createDataFrame(
                [], "namespace string, table string, load_id string, load_part string, file string, rows bigint"
            )
        files = _union(
            [
                self._read_loads(group, schema).select(
                    LOAD_COLUMN, PART_COLUMN, F.col("_metadata.file_path").alias("file")
                )
                for group in _by_folder(loads)
            ]
        )
        renamed = {e.path.rsplit("/", 1)[1]: e.load_id for e in loads if not e.path.endswith(f"/{segment(LOAD_COLUMN, e.load_id)}")}
        load = F.col(LOAD_COLUMN)
        for folder, name in renamed.items():  # ids that an earlier life of the table had used
            load = F.when(F.col(LOAD_COLUMN) == unquote(folder.split("=", 1)[1]), F.lit(name)).otherwise(load)
        return files.groupBy(LOAD_COLUMN, PART_COLUMN, "file").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(self.namespace).alias("namespace"),
            F.lit(self.name).alias("table"),
            load.alias("load_id"),
            F.col(PART_COLUMN).alias("load_part"),
            "file",
            "rows",
        )

    # -- reads --------------------------------------------------------------------------------------

    def _check_version(self, entries: list[Entry], version: int) -> int:
        if version not in [e.seq for e in entries]:
            raise VersionNotFound(f"table {self.namespace}.{self.name} has no version {version}")
        return version

    def resolve(self, as_of: int | str | datetime | None) -> int | None:
        """Sequence number of a version given as a number, a tag or a moment."""
        if as_of is None:
            return None
        entries = self.entries()
        if isinstance(as_of, int):
            return self._check_version(entries, as_of)
        if isinstance(as_of, datetime):
            # ledger times arrive on the driver in its local time
            moment = as_of if as_of.tzinfo is None else as_of.astimezone().replace(tzinfo=None)
            before = [e.seq for e in entries if e.published_at is not None and e.published_at <= moment]
            if not before:
                raise VersionNotFound(f"table {self.namespace}.{self.name} has no version at {as_of}")
            return max(before)
        tags = [e for e in entries if e.op == "tag" and e.props.get("tag") == as_of]
        if not tags:
            raise VersionNotFound(f"table {self.namespace}.{self.name} has no tag {as_of!r}")
        return int(tags[-1].props["seq"])

    def read(
        self,
        columns: Sequence[str] | None = None,
        where: Column | str | None = None,
        between: Mapping[str, tuple[object, object]] | None = None,
        as_of: int | str | datetime | None = None,
        since: int | None = None,
        positions: bool = False,
        partitions: bool = False,
        touched_only: bool | None = None,
    ) -> DataFrame:
        """Visible rows, now or as of a version, or only those of loads after version ``since`` (0: all).

        Deleted positions are taken out by an anti-join. A delete set whose rows, as they lie in memory, fit what Spark may
        broadcast is broadcast; a larger one as bitmaps of the touched files' rows, up to ``BITMAP_BYTES``. Beyond that
        the files that it touches are told apart first: only their rows are shuffled, and each file is
        scanned once. ``touched_only`` forces one way (False: one join; True: files told apart by joins). A ``since`` before the last replace or
        truncate is refused, as the rows read up to then are void.

        ``between`` bounds a column and skips the folders outside, where the table is partitioned by it.
        ``positions`` adds file and row position, ``partitions`` the partition values.
        """
        version = self.resolve(as_of)
        entries = self.entries()
        if since:
            self._check_version(entries, since)
        if not live_entries(entries, version):
            raise TableNotFound(f"no table {self.namespace}.{self.name}")
        shown = visible_entries(entries, version)
        schema, specs = shown[-1].schema, shown[-1].partitions
        loads = [e for e in shown if e.op in LOADS and e.rows and (since is None or e.span[1] > since)]
        if since and any(e.op in ("replace", "truncate", "drop") and e.seq > since and (version is None or e.seq <= version) for e in entries):
            raise VersionNotFound(f"the rows of {self.namespace}.{self.name} up to version {since} were replaced")
        if since is not None and any(e.span[0] <= since for e in loads):
            raise VersionNotFound(f"versions around {since} of {self.namespace}.{self.name} have been rolled up")
        deletes = [e for e in shown if e.op == "delete" and e.rows]
        transforms = [Transform.parse(s) for s in specs]
        kept = schema.names + [t.column for t in transforms]

        rows = self._rows(loads, deletes, schema, specs, positions, touched_only)
        for name, (low, high) in (between or {}).items():
            rows = rows.filter(quoted(name).between(low, high))
            for t in transforms:
                bound = t.between(low, high, schema[name].dataType) if t.source == name else None
                rows = rows if bound is None else rows.filter(bound)
        rows = rows.select(*[quoted(n) for n in kept], *([FILE_COLUMN, POSITION_COLUMN] if positions else []))
        if where is not None:
            rows = rows.filter(where)
        shown_columns = list(columns) if columns is not None else schema.names
        if partitions:
            shown_columns = shown_columns + [t.column for t in transforms]
        if positions:
            shown_columns = shown_columns + [FILE_COLUMN, POSITION_COLUMN]
        return rows.select(*[quoted(c) for c in shown_columns])

    def changes(self, as_of: int | str | datetime | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version as a change feed, with the version's number and commit time.

        ``lsn`` is a row's position in its file; with ``load_part``, the file's name, it is unique in the table.
        """
        version = self.resolve(as_of)
        entry = self._live(version)[-1]
        rows = self.read(columns, as_of=version, positions=True)
        moment = int(entry.published_at.timestamp() * 1_000_000) * 1000 if entry.published_at else None
        return table_to_changes(
            rows, self.namespace, self.name, str(entry.seq), moment, F.col(POSITION_COLUMN), F.col(FILE_COLUMN), list(columns or self.schema(version).names)
        )

    def _read_loads(self, loads: Sequence[Entry], schema: T.StructType) -> DataFrame:
        """One scan over the folders of the given loads; other folders are not even listed."""
        stored, specs = loads[-1].schema, loads[-1].partitions
        fields = list(schema.fields) + [T.StructField(LOAD_COLUMN, T.StringType())]
        for t in map(Transform.parse, specs):
            fields.append(T.StructField(t.column, t.result_type(stored[t.source].dataType)))
        base = loads[0].path.rsplit("/", 1)[0]
        return self.spark.read.schema(T.StructType(fields)).option("basePath", base).parquet(*[e.path for e in loads])

    def _scan(self, loads: Sequence[Entry], schema: T.StructType, specs: Sequence[str], positions: bool) -> DataFrame:
        transforms = [Transform.parse(s) for s in specs]
        wanted = [quoted(n) for n in schema.names] + [quoted(t.column) for t in transforms]
        if positions:
            wanted += [
                F.col("_metadata.file_path").alias(FILE_COLUMN),
                F.col("_metadata.row_index").alias(POSITION_COLUMN),
            ]
        owned = [e for e in loads if e.op != "register"]
        frames = [self._read_loads(group, schema).select(*wanted) for group in _by_folder(owned)]
        for entry in loads:
            if entry.op == "register":
                found = self._registered(entry, schema, positions)
                for t in transforms:
                    found = found.withColumn(t.column, t.value(quoted(t.source), schema[t.source].dataType))
                own = [quoted(n) for n in schema.names] + [quoted(t.column) for t in transforms]
                frames.append(found.select(*own, *([FILE_COLUMN, POSITION_COLUMN] if positions else [])))
        if not frames:
            fields = list(schema.fields)
            fields += [T.StructField(t.column, t.result_type(schema[t.source].dataType)) for t in transforms]
            empty = self.spark.createDataFrame([], T.StructType(fields + (DELETE_SCHEMA.fields if positions else [])))
            return empty
        return _union(frames)

    def _rows(
        self,
        loads: Sequence[Entry],
        deletes: Sequence[Entry],
        schema: T.StructType,
        specs: Sequence[str],
        positions: bool,
        touched_only: bool | None = None,
    ) -> DataFrame:
        rows = self._scan(loads, schema, specs, bool(deletes) or positions)
        return self._without_deleted(rows, deletes, touched_only) if deletes else rows

    def _without_deleted(self, rows: DataFrame, deletes: Sequence[Entry], touched_only: bool | None) -> DataFrame:
        gone = self.spark.read.schema(DELETE_SCHEMA).parquet(*[e.path for e in deletes])
        keys = [FILE_COLUMN, POSITION_COLUMN]
        limit = _broadcast_limit(self.spark)
        name = max(len(e.path) for e in deletes) + 128  # a joined row holds its file's name twice
        if sum(e.rows for e in deletes) * (2 * name + 64) > limit:
            # Spark goes by the size of the files, where names and positions are encoded, and would broadcast far too much
            gone = gone.hint("merge")
            if touched_only is None and limit > 0:
                blocks = gone.select(FILE_COLUMN, _block()).distinct().count()
                if blocks * (2 * name + 64 + BLOCK_ROWS // 8) <= BITMAP_BYTES:
                    return _without_marked(rows, gone)
        elif touched_only is None:
            return rows.join(gone, keys, "left_anti")
        if touched_only is None:
            names = [r[0] for r in gone.select(FILE_COLUMN).distinct().take(TOUCHED_FILES + 1)]
            if len(names) <= TOUCHED_FILES:  # the scans skip files by name
                touched = F.col(FILE_COLUMN).isin(names)
                return rows.filter(~touched).unionByName(rows.filter(touched).join(gone, keys, "left_anti"))
        elif not touched_only:
            return rows.join(gone, keys, "left_anti")
        touched = gone.select(FILE_COLUMN).distinct()
        clean = rows.join(touched, FILE_COLUMN, "left_anti")
        return clean.unionByName(rows.join(touched, FILE_COLUMN, "left_semi").join(gone, keys, "left_anti"))

    def count(self, exact: bool = True) -> int:
        """Live rows; ``exact=False`` takes the ledger's total, which does not subtract deleted rows."""
        if exact:
            return self.read().count()
        entries = self.entries()
        if not live_entries(entries):
            raise TableNotFound(f"no table {self.namespace}.{self.name}")
        return loaded_rows(entries)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _listed_files(frames: Sequence[DataFrame]) -> str:
    """Number and digest of the names of the files that the frames scan; one text for all names comes from the JVM."""
    digest, count = hashlib.sha256(), 0
    for frame in frames:
        files = frame.sparkSession._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(frame._jdf.inputFiles())
        names = sorted(files.mkString("\n").split("\n"))
        digest.update("\n".join(names).encode())
        count += files.length()
    return f"{count} {digest.hexdigest()}"


def _block() -> Column:
    """Which block of its file a row lies in."""
    return F.shiftright(POSITION_COLUMN, BLOCK_ROWS.bit_length() - 1).alias("_block")


def _without_marked(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows that no bitmap of deleted positions marks. One bit a row of a touched block is broadcast, whatever is deleted."""
    place = F.col(POSITION_COLUMN).bitwiseAND(F.lit(BLOCK_ROWS - 1))
    marks = gone.groupBy(FILE_COLUMN, _block()).agg(F.bitmap_construct_agg(place).alias("_bits"))
    # as numbers of eight bytes, which a row looks up without copying its block's bitmap
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_ROWS // 64 - 1)),
        lambda i: F.conv(F.hex(F.substring("_bits", 8 * i + 1, F.lit(8))), 16, -10).cast("bigint"),
    )
    marks = marks.select(F.col(FILE_COLUMN).alias("_marked_file"), F.col("_block").alias("_marked_block"), words.alias("_marked"))
    bit = 8 * (7 - F.shiftright(place, 3).bitwiseAND(F.lit(7))) + place.bitwiseAND(F.lit(7))  # the first byte is a word's highest
    deleted = F.getbit(F.get("_marked", F.shiftright(place, 6).cast("int")), bit.cast("int")) == 1
    same = (F.col(FILE_COLUMN) == F.col("_marked_file")) & (_block() == F.col("_marked_block"))
    return rows.join(F.broadcast(marks), same & deleted, "left_anti")


def _broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _by_folder(loads: Sequence[Entry]) -> list[list[Entry]]:
    """Loads grouped by table folder: a branch begins with loads that lie in its origin's folder."""
    groups: dict[str, list[Entry]] = {}
    for load in loads:
        groups.setdefault(load.path.rsplit("/", 1)[0], []).append(load)
    return list(groups.values())


def _is_there(spark: SparkSession, path: str) -> bool:
    """Whether a folder of Parquet files was written, perhaps without rows."""
    try:
        spark.read.schema("_none int").option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _new_id(op: str) -> str:
    return f"{op}-{uuid.uuid4().hex}"
