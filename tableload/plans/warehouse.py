"""All tables below one root: listing, and loading of mixed change feeds."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableload.functions.names import join_id
from tableload.functions.types import ColSchema, to_struct_type
from tableload.operators.conform import conform
from tableload.operators.feed import (
    CLEANUP_KINDS,
    DONE_KINDS,
    ROW_KINDS,
    after_clean_up,
    feed_columns,
    include_tables,
    only_table,
    with_default_namespace,
)
from tableload.operators.transform import Transform, transform_of
from tableload.plans.ledger import LOADS, ROLLED_UP, STARTS, Entry, ledger_frame, segment
from tableload.plans.table import PART_COLUMN, Table
from tableload.session import path_exists, remove_folder

TableId = tuple[str, str]
Schemas = Mapping[TableId, Sequence[ColSchema]]


class Warehouse:
    """``writers`` is the number of tables of one feed that are loaded at a time."""

    def __init__(self, spark: SparkSession, root: str, writers: int = 4) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.writers = writers

    def table(self, namespace: str, name: str) -> Table:
        return Table(self.spark, self.root, namespace, name)

    def table_exists(self, namespace: str, name: str) -> bool:
        return self.table(namespace, name).exists()

    def list_tables(self, namespace: str | None = None, include: Iterable[str] | None = None) -> DataFrame:
        """Live tables with their estimated rows (deleted rows not subtracted) and schema."""
        ledger = include_tables(ledger_frame(self.spark, self.root, namespace), include)
        key = ["namespace", "table"]
        latest = ledger.groupBy(*key).agg(
            F.max_by(F.struct("op", "schema_json"), "seq").alias("latest"),
            F.coalesce(F.max(F.when(F.col("op").isin(*STARTS, "drop"), F.col("seq"))), F.lit(0)).alias("start"),
        )
        live = latest.filter("latest.op <> 'drop'")
        loads = ledger.filter(F.col("op").isin(*LOADS)).select(*key, "seq", "op", "rows", "props").join(live, key).filter("seq >= start")
        rollups = loads.filter("op = 'rollup'").select(
            *key,
            F.col("seq").alias("at"),
            *[F.try_element_at("props", F.lit(p)).cast("bigint").alias(n) for p, n in zip(ROLLED_UP, ("first", "last"))],
        )
        # a load that a later roll-up stands for is not counted
        begins = F.coalesce(F.try_element_at("l.props", F.lit(ROLLED_UP[0])).cast("bigint"), F.col("l.seq"))
        inside = begins.between(F.col("r.first"), F.col("r.last")) & (F.col("l.seq") < F.col("r.at"))
        same = (F.col("l.namespace") == F.col("r.namespace")) & (F.col("l.table") == F.col("r.table"))
        counted = loads.alias("l").join(rollups.alias("r"), same & inside, "left_anti")
        totals = counted.groupBy(*key).agg(F.sum("rows").alias("rows"))
        return live.join(totals, key, "left").select(
            *key,
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
            F.lit(False).alias("is_view"),
            F.col("latest.schema_json").alias("schema_json"),
        )

    # -- change feeds -------------------------------------------------------------------------------

    def load_feed(
        self,
        feed: DataFrame,
        schemas: Schemas,
        load_id: str | None = None,
        mode: str = "append",
        props: Mapping[str, str] | None = None,
        default_namespace: str | None = None,
        on_error: str | None = None,
        include: Iterable[str] | None = None,
        stage: bool = True,
        transforms: Sequence[Transform] = (),
    ) -> list[Entry]:
        """Bulk load of a feed of any number of tables, each published on its own once all its rows are written.

        Drop and truncate events act in the order of the feed (``lsn``): rows at or before the last one of their table are
        void, later ones are loaded. Events without a position act before all rows, and rows without one count as later.
        Events act once per load id: a retry does not repeat them. Only
        insert rows are taken; rows of unknown kinds are refused. The feed is written once, split by table, so that
        the source is read once; ``stage=False`` filters it again for each table instead. The staged copy is removed
        when all tables are published. ``transforms`` are run over the rows of the tables they are for.
        """
        load_id = load_id or f"load-{uuid.uuid4().hex}"
        feed = include_tables(with_default_namespace(feed, default_namespace), include)
        if stage:
            feed = self._stage(feed, load_id)
        counts, control = self._plan(feed, schemas)
        self._clean_up(control, schemas, load_id)
        after = _last_points(control)
        if after:  # of the tables that are cleaned up, only later rows count
            rows = feed.filter(F.col("kind") == "insert")
            points = self.spark.createDataFrame([(*key, lsn) for key, lsn in after.items()], "namespace string, table string, lsn bigint")
            left = after_clean_up(rows, points).groupBy("namespace", "table").count().collect()  # declared tables only
            counts = {(r["namespace"], r["table"]): r["count"] for r in left}
        entries = self._load_tables(feed, schemas, counts, load_id, mode, props, on_error, transforms, after)
        if stage:
            remove_folder(self.spark, self._staging(load_id))
        return entries

    def _clean_up(self, control: Mapping[tuple[TableId, str], int | None], schemas: Schemas, load_id: str) -> None:
        """Drop and truncate tables in the order of the events' last positions; those without one come first."""
        for (key, kind), _ in sorted(control.items(), key=lambda e: (e[0][0], e[1] is not None, e[1] or 0, e[0][1])):
            if kind == "drop":
                self.table(*key).drop(load_id=f"{load_id}-drop")
            elif kind == "truncate":
                self.table(*key).truncate(schemas.get(key), load_id=f"{load_id}-truncate")

    # -- loads in parts, published when the feed says that all are done -----------------------------

    def stage_feed(
        self,
        feed: DataFrame,
        schemas: Schemas,
        load_id: str,
        mode: str = "append",
        props: Mapping[str, str] | None = None,
        default_namespace: str | None = None,
        on_error: str | None = None,
        include: Iterable[str] | None = None,
    ) -> list[Entry]:
        """One worker's share of a load: rows are staged by table and part, and what the feed says is done is noted.

        Any number of calls, in any order and from any number of workers, make up one load. A table is published, by the call
        that completes it, once its ``done_sharded`` event has come and every part has ended: those that it lists
        (``column_names``) and those that have rows. A part has ended with its ``done_table`` event (``load_part``), which comes with its
        rows or after them; a part may end without rows. Rows of a part that come again replace it; what comes after the
        publish changes nothing. Clean-up events act at once, before the rows of the call, once per load id.
        Entries of the tables that are complete are returned.
        """
        feed = include_tables(with_default_namespace(feed, default_namespace), include)
        call = f"{load_id}-{uuid.uuid4().hex}"
        feed = self._stage(feed, call)
        _, control = self._plan(feed, schemas)
        self._clean_up(control, schemas, load_id)
        inserts = feed.filter(F.col("kind") == "insert").withColumn("load_part", F.coalesce("load_part", F.lit("")))
        parts = [tuple(r) for r in inserts.select("namespace", "table", "load_part").distinct().collect()]  # one row a part
        for key in sorted({p[:2] for p in parts}):
            self.table(*key).ensure(schemas[key])

        def stage(part: tuple[str, str, str]) -> None:
            table = self.table(*part[:2])
            if not table.has_load(load_id):
                rows = only_table(inserts, *part[:2]).filter(F.col("load_part") == part[2])
                table.stage_part(feed_columns(rows, schemas[part[:2]]), load_id, part[2], on_error)

        with ThreadPoolExecutor(self.writers) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(stage), sorted(parts)))
        noted = feed.filter(F.col("kind").isin(*DONE_KINDS)).select("namespace", "table", "kind", F.coalesce("load_part", F.lit("")).alias("load_part"), "column_names")
        seen = inserts.select("namespace", "table", F.lit("rows").alias("kind"), "load_part", F.lit(None).cast("array<string>").alias("column_names")).distinct()
        noted.unionByName(seen).coalesce(1).write.parquet(f"{self._progress(load_id)}/{segment('call', call)}")
        remove_folder(self.spark, self._staging(call))
        return self.publish_complete(schemas, load_id, mode, props)

    def progress(self, load_id: str) -> DataFrame:
        """(namespace, table, staged, ended, announced, closed, complete) of a load in parts, as far as calls have noted it."""
        schema = "namespace string, table string, kind string, load_part string, column_names array<string>"
        path = self._progress(load_id)
        notes = self.spark.createDataFrame([], schema)
        if path_exists(self.spark, path):
            notes = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

        def parts(kind: str):
            return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("load_part"))))

        listed = F.flatten(F.collect_list(F.when(F.col("kind") == "done_sharded", F.col("column_names"))))
        found = notes.groupBy("namespace", "table").agg(
            parts("rows").alias("staged"), parts("done_table").alias("ended"), F.array_sort(F.array_distinct(listed)).alias("announced"),
            F.bool_or(F.col("kind") == "done_sharded").alias("closed"),
        )
        missing = F.array_except(F.array_union("announced", "staged"), "ended")
        return found.withColumn("complete", F.col("closed") & (F.size(missing) == 0))

    def publish_complete(self, schemas: Schemas, load_id: str, mode: str = "append", props: Mapping[str, str] | None = None) -> list[Entry]:
        """Publish the tables of a load in parts that are complete; those that are published already are only named."""
        entries = []
        for row in self.progress(load_id).filter("complete").orderBy("namespace", "table").collect():  # one row a table
            key = (row["namespace"], row["table"])
            table = self.table(*key)
            if row["staged"]:
                entries.append(table.publish_parts(load_id, row["staged"], mode, props))
            else:  # all parts ended without rows
                empty = self.spark.createDataFrame([], to_struct_type(schemas[key]))
                entries.append(table.load(empty, schemas[key], load_id, mode, props))
        return entries

    def _progress(self, load_id: str) -> str:
        return f"{self.root}/progress/{segment('load', load_id)}"

    def append_batch(
        self,
        feed: DataFrame,
        schemas: Schemas,
        load_id: str,
        props: Mapping[str, str] | None = None,
        default_namespace: str | None = None,
        on_error: str | None = None,
        stage: bool = False,
        transforms: Sequence[Transform] = (),
    ) -> list[Entry]:
        """One micro-batch of a stream: control events are dropped, the rest is appended.

        Rows, bytes and time of each table's share are noted (``Table.metrics``). The batch is kept in memory and on disk while its tables are loaded; with ``stage``, for streams of very many
        tables, it is written once, split by table, and removed after the publish.
        """
        feed = with_default_namespace(feed, default_namespace)
        feed = self._stage(feed, load_id) if stage else feed.persist()
        try:
            counts, _ = self._plan(feed, schemas)
            entries = self._load_tables(feed, schemas, counts, load_id, "append", props, on_error, transforms, measure=True)
        finally:
            feed.unpersist()
        if stage:
            remove_folder(self.spark, self._staging(load_id))
        return entries

    def _plan(self, feed: DataFrame, schemas: Schemas) -> tuple[dict[TableId, int], dict[tuple[TableId, str], int | None]]:
        """Rows per table, and the last position of the clean-up events of each table and kind.

        What reaches the driver is bounded by the declared tables and the tables to clean up: rows of
        undeclared tables are counted together.
        """
        declared = F.lit(False)
        for namespace in {key[0] for key in schemas}:
            names = [key[1] for key in schemas if key[0] == namespace]
            declared = declared | ((F.col("namespace") == namespace) & F.col("table").isin(names))
        kind = F.when(F.col("kind").isin(*ROW_KINDS, *CLEANUP_KINDS), F.col("kind"))
        unknown = ~F.coalesce(F.col("kind").isin(*ROW_KINDS, *CLEANUP_KINDS, *DONE_KINDS), F.lit(False))
        named = declared | F.col("kind").isin(*CLEANUP_KINDS)
        summary = feed.groupBy(
            F.when(named, F.col("namespace")).alias("namespace"), F.when(named, F.col("table")).alias("table"), kind.alias("kind")
        ).agg(F.count(F.lit(1)).alias("rows"), F.count_if(unknown).alias("unknown"), F.min(join_id(F.col("namespace"), F.col("table"))).alias("example"), F.max("lsn").alias("lsn"))
        counts: dict[TableId, int] = {}
        control: dict[tuple[TableId, str], int | None] = {}
        for row in summary.collect():
            key = (row["namespace"], row["table"])
            if row["unknown"]:
                raise ValueError(f"{row['unknown']} rows of an unknown kind, as for {row['example']}")
            if row["kind"] in CLEANUP_KINDS:
                control[key, row["kind"]] = row["lsn"]
            elif row["kind"] in ROW_KINDS and row["kind"] != "insert":
                raise ValueError(f"{row['rows']} {row['kind']} rows, as for {row['example']}: only inserts can be loaded")
            elif row["kind"] == "insert" and row["table"] is None:
                raise ValueError(f"no schema declared for the table of {row['rows']} rows, as for {row['example']}")
            elif row["kind"] == "insert":
                counts[key] = row["rows"]
        return counts, control

    def _load_tables(
        self,
        feed: DataFrame,
        schemas: Schemas,
        counts: Mapping[TableId, int],
        load_id: str,
        mode: str,
        props: Mapping[str, str] | None,
        on_error: str | None,
        transforms: Sequence[Transform] = (),
        after: Mapping[TableId, int] | None = None,
        measure: bool = False,
    ) -> list[Entry]:
        inserts = feed.filter(F.col("kind") == "insert")
        chosen = {key: transform_of(transforms, key) for key in counts}
        targets = [t.into if t and t.into else key for key, t in chosen.items()]
        if len(set(targets)) < len(targets):
            raise ValueError("several tables of the feed would go into one")

        def load(key: TableId) -> Entry:
            rows = only_table(inserts, *key)
            if after and key in after:
                rows = rows.filter(F.coalesce(F.col("lsn") > after[key], F.lit(True)))
            if transform := chosen[key]:
                result, cols = transform.run(conform(feed_columns(rows, schemas[key]), schemas[key], on_error))
                return self.table(*(transform.into or key)).load(result, cols, load_id, mode, props, on_error, measure=measure)
            rows = feed_columns(rows, schemas[key], ["load_part"])
            entry = self.table(*key).load(
                rows, schemas[key], load_id, mode, props, on_error, load_part=F.col("load_part"), measure=measure
            )
            if entry.rows != counts[key]:
                raise RuntimeError(f"{'.'.join(key)}: {entry.rows} rows written, {counts[key]} in the feed")
            return entry

        with ThreadPoolExecutor(self.writers) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(load), sorted(counts)))

    def _staging(self, load_id: str) -> str:
        return f"{self.root}/staging/{segment('load', load_id)}"

    def _stage(self, feed: DataFrame, load_id: str) -> DataFrame:
        """The feed written once, one folder per table and kind, in few files each: a table's load prunes the rest."""
        path = self._staging(load_id)
        folders = ["namespace", "table", "kind"]
        feed.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).parquet(path)
        fields = [f for f in feed.schema.fields if f.name not in folders]
        fields += [T.StructField(n, T.StringType()) for n in folders]
        # the empty name comes back from a folder as null
        return with_default_namespace(self.spark.read.schema(T.StructType(fields)).parquet(path), None)


def _last_points(control: Mapping[tuple[TableId, str], int | None]) -> dict[TableId, int]:
    """The last position of any clean-up event of each table that has one."""
    out: dict[TableId, int] = {}
    for (key, _), lsn in control.items():
        if lsn is not None:
            out[key] = max(lsn, out.get(key, lsn))
    return out


def manifest(warehouse: Warehouse, tables: Iterable[TableId], load_ids: Sequence[str] | None = None) -> DataFrame:
    """Rows per table, load, part and file over several tables."""
    frames = [warehouse.table(*key).manifest(load_ids) for key in tables]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def collect_parts(manifest_frame: DataFrame) -> DataFrame:
    """Parts, files and rows of every load, per table."""
    return manifest_frame.groupBy("namespace", "table", "load_id").agg(
        F.count_distinct("load_part").alias("parts"), F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")
    )


__all__ = ["PART_COLUMN", "Warehouse", "collect_parts", "manifest"]
