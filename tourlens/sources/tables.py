"""Table registry and table store.

A table is cut into cells: the values of its partition column, or hash buckets of its key. Each
write puts its cells into a folder of its own, `<root>/<name>/load=<id>/<cell>/`, and then
switches to them by one small pointer file in `<root>/<name>/_pointers`, which names the load of every cell. Readers
take the newest pointer, so a write never touches files being read, a failed one stays
invisible, and a merge writes the cells with a touched key and no others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from contextlib import nullcontext
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tourlens import schemas
from tourlens.sources import workspace


@dataclass(frozen=True)
class Table:
    ddl: str
    key: tuple[str, ...] = ()
    partition: str | None = None
    cluster: str | None = None
    # Raw tables grow by new columns; the others always have exactly the columns of `ddl`.
    grows: bool = False
    # Without a partition column: cells by a hash of the key.
    buckets: int = 0


#: Buckets of a keyed table, unless its store says otherwise: a merge of few keys rewrites few of them.
BUCKETS = 8

# Table names, keys and layout.
TABLES = {
    "ticketmaster_events": Table(schemas.RAW_EVENTS, ("event_id",), grows=True, buckets=BUCKETS),
    "setlistfm_setlists": Table(schemas.RAW_SETLISTS, ("setlist_id",), grows=True, buckets=BUCKETS),
    "musicbrainz_artists": Table(schemas.RAW_ARTISTS, ("mbid",), grows=True, buckets=BUCKETS),
    "artist_resolution": Table(schemas.ARTIST_RESOLUTION, ("cache_key",), buckets=BUCKETS),
    "dim_artist": Table(schemas.DIM_ARTIST, ("artist_id",), buckets=BUCKETS),
    "fact_concert": Table(schemas.FACT_CONCERT, ("concert_id",), "event_month", "artist_id"),
    "mart_artist_touring_intensity": Table(schemas.TOURING_INTENSITY),
    "mart_artist_yearly_repertoire": Table(schemas.YEARLY_REPERTOIRE),
    "mart_artist_setlist_freshness": Table(schemas.SETLIST_FRESHNESS),
    "spark_artist_similarity": Table(schemas.ARTIST_SIMILARITY, ("artist_a", "artist_b")),
    "live_event_updates": Table(schemas.LIVE_UPDATES),
    "dim_artist_watermark": Table(schemas.WATERMARK),
    "fact_concert_watermark": Table(schemas.WATERMARK),
}

RAW_TABLES = ("ticketmaster_events", "setlistfm_setlists", "musicbrainz_artists")
CORE_TABLES = ("dim_artist", "fact_concert", "dim_artist_watermark", "fact_concert_watermark")


def typed_empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Required snapshot: a missing one reads as an empty frame of the right type."""
    if not workspace.exists(spark, path):
        return typed_empty(spark, ddl)
    return spark.read.schema(ddl).parquet(path)


def read_optional(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """Optional snapshot: a missing one is 'no data', not an error."""
    return spark.read.schema(ddl).parquet(path) if workspace.exists(spark, path) else None


def read_optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """As `read_optional`, for a table or view of the session catalog."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def parameter_list(spark: SparkSession, text: str, name: str) -> DataFrame:
    """'a, b,c' (quotes allowed) as rows (name, position). Bounded by the setting's length."""
    items = [i.strip() for i in text.strip('"').strip("'").split(",") if i.strip()]
    return spark.createDataFrame(
        [(item, rank) for rank, item in enumerate(items)], f"{name} STRING, position INT"
    )


def with_columns_of(df: DataFrame, ddl: str) -> DataFrame:
    """Bring a frame to a target schema: add missing columns as null, drop the others."""
    target = typed_empty(df.sparkSession, ddl).schema
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


@dataclass
class Pointer:
    """Which load holds each current cell; `cells` of a table without cells has the one key ''."""

    schema: str
    buckets: int = 0
    cells: dict[str, str] = field(default_factory=dict)
    # Cells that each load wrote: a load that is current as a whole is read as one folder.
    sizes: dict[str, int] = field(default_factory=dict)


class TableStore:
    """Named parquet tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- pointers ------------------------------------------------------------

    def _pointers(self, name: str) -> list[str]:
        folder = f"{self.root}/{name}/_pointers"
        return [f"{folder}/{p}" for p in workspace.children(self.spark, folder) if not p.endswith(".tmp")]

    def _load_pointer(self, path: str) -> Pointer:
        return Pointer(**json.loads(workspace.read_text(self.spark, path)))

    def current(self, name: str) -> Pointer | None:
        paths = self._pointers(name)
        return self._load_pointer(paths[-1]) if paths else None

    def _switch(self, name: str, pointer: Pointer) -> None:
        """Make a pointer the current one. The one before it stays for readers that already follow it."""
        paths = self._pointers(name)
        number = int(paths[-1].rsplit("/", 1)[1]) + 1 if paths else 1
        workspace.write_text(self.spark, f"{self.root}/{name}/_pointers/{number:08d}", json.dumps(asdict(pointer)))
        if len(paths) < 2:
            return
        kept = [pointer, self._load_pointer(paths[-1])]
        used = {(cell, load) for p in kept for cell, load in p.cells.items()}
        loads = {load for p in kept for load in p.cells.values()}
        for path in paths[:-1]:
            for cell, load in self._load_pointer(path).cells.items():
                if load not in loads:
                    workspace.delete(self.spark, f"{self.root}/{name}/load={load}")
                elif (cell, load) not in used:
                    workspace.delete(self.spark, f"{self.root}/{name}/load={load}/{cell}")
            workspace.delete(self.spark, path)

    def draft(self) -> Draft:
        """A store whose writes only it can see until they are published together."""
        return Draft(self)

    # -- reading -------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def paths(self, name: str) -> list[str]:
        """Folders that hold the current cells."""
        now = self.current(name)
        if now is None:
            return []
        held: dict[str, list[str]] = {}
        for cell, load in now.cells.items():
            held.setdefault(load, []).append(cell)
        base = f"{self.root}/{name}/load="
        whole = [f"{base}{load}" for load, cells in held.items() if len(cells) == now.sizes[load]]
        parts = [f"{base}{load}/{cell}" for load, cells in held.items() if len(cells) < now.sizes[load] for cell in cells]
        return sorted(whole + parts)

    def read(self, name: str) -> DataFrame:
        """The current rows; a table never written reads as empty."""
        return self._cells(name).drop("load", "bucket")

    def _cells(self, name: str) -> DataFrame:
        """The current rows with their load and, in a bucketed table, their bucket."""
        table, now, paths = TABLES[name], self.current(name), self.paths(name)
        schema = typed_empty(self.spark, table.ddl).schema if now is None else StructType.fromJson(json.loads(now.schema))
        cell = "bucket INT, load STRING" if now is not None and now.buckets else "load STRING"
        schema = StructType([*schema.fields, *typed_empty(self.spark, cell).schema.fields])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def register_views(self, names: Iterable[str]) -> None:
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    # -- writing -------------------------------------------------------------

    def _bucket(self, table: Table, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*table.key), F.lit(buckets)).cast("int")

    def _write(self, name: str, df: DataFrame, buckets: int) -> Pointer:
        """`df` in a load of its own, which nobody reads yet, and the pointer to it alone."""
        table, load = TABLES[name], f"l{uuid.uuid4().hex}"
        part = table.partition or ("bucket" if buckets else None)
        schema = df.schema.json()
        path = f"{self.root}/{name}/load={load}"
        if part is None:
            df.write.parquet(path)
            return Pointer(schema, 0, {"": load}, {load: 1})
        if table.partition is None:
            df = df.withColumn("bucket", self._bucket(table, buckets))
        # Rebalancing splits an oversized cell over several tasks and merges small ones,
        # where a plain repartition by cell would put each in one task.
        order = [part] + ([table.cluster] if table.cluster else [])
        df.hint("rebalance", F.col(part)).sortWithinPartitions(*order).write.partitionBy(part).parquet(path)
        cells = [c for c in workspace.children(self.spark, path) if c.startswith(f"{part}=")]
        return Pointer(schema, buckets, {c: load for c in cells}, {load: len(cells)})

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Replace the table and switch to the new rows. `df` may read the current ones."""
        self._switch(name, self._write(name, df, TABLES[name].buckets and (self.buckets or TABLES[name].buckets)))
        return self.read(name)

    def upsert(self, name: str, rows: DataFrame, removed: DataFrame | None = None, settled: bool = False) -> DataFrame:
        """Insert or replace `rows` by the table's key, and delete the keys in `removed`.

        `rows` must hold each key once; see `operators.keyed.latest_per_key`. They are read several times, so unless
        they are `settled` already they are written to scratch space first. Only cells that hold a touched key, now or
        before, are written again.
        """
        table, now = TABLES[name], self.current(name)
        if not table.grows:
            rows = with_columns_of(rows, table.ddl)
        if now is None:
            if removed is not None:
                rows = rows.join(removed.select(*table.key), list(table.key), "left_anti")
            return self.overwrite(name, rows)
        with nullcontext(rows) if settled else workspace.staged(rows, f"upsert-{name}") as rows:
            key = list(table.key)
            touched = rows.select(*key)
            touched = touched if removed is None else touched.union(removed.select(*key))
            old = self._cells(name)
            part = table.partition or ("bucket" if now.buckets else None)
            if part is None:
                kept, affected = old, set(now.cells)
            else:
                # Values of a cell: bounded by the calendar or the buckets, not by the data.
                if table.partition:
                    holding = old.select(*key, part).join(touched, key, "left_semi").select(part).union(rows.select(part))
                else:
                    holding = touched.select(self._bucket(table, now.buckets).alias(part))
                values = {r[0] for r in holding.distinct().collect()}
                kept = old.where(_in(F.col(part), values))
                affected = {_folder(part, v) for v in values}
            kept = kept.drop("load", "bucket").join(touched, key, "left_anti")
            written = self._write(name, kept.unionByName(rows, allowMissingColumns=True), now.buckets)
            cells = {c: load for c, load in now.cells.items() if c not in affected} | written.cells
            sizes = {load: n for load, n in (now.sizes | written.sizes).items() if load in cells.values()}
            self._switch(name, Pointer(written.schema, now.buckets, cells, sizes))
        return self.read(name)

    def reset(self, names: Iterable[str], views: Iterable[str] = (), confirm: bool = False) -> None:
        """Empty tables and drop views; refuses unless confirmed."""
        if not confirm:
            raise ValueError("refusing to wipe data without confirm=True")
        for name in names:
            # An empty table needs a file for its schema to survive, hence one partition.
            self.overwrite(name, typed_empty(self.spark, TABLES[name].ddl).coalesce(1))
        for view in views:
            self.spark.catalog.dropTempView(view)


class Draft(TableStore):
    """Writes on top of a store that nobody else sees: checked first, then published, or discarded."""

    def __init__(self, store: TableStore):
        super().__init__(store.spark, store.root, store.buckets)
        self.store = store
        self.written: dict[str, list[Pointer]] = {}

    def current(self, name: str) -> Pointer | None:
        return self.written[name][-1] if name in self.written else self.store.current(name)

    def _switch(self, name: str, pointer: Pointer) -> None:
        self.written.setdefault(name, []).append(pointer)

    def publish(self) -> None:
        """Switch the store to what was written, table by table in the order of their first writes."""
        for name, pointers in self.written.items():
            self.store._switch(name, pointers[-1])
        self.written = {}

    def discard(self) -> None:
        """Delete what was written."""
        for name, pointers in self.written.items():
            before = self.store.current(name)
            known = set(before.cells.values()) if before else set()
            for load in {load for p in pointers for load in p.cells.values()} - known:
                workspace.delete(self.spark, f"{self.root}/{name}/load={load}")
        self.written = {}


def _folder(part: str, value) -> str:
    return f"{part}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _in(c: Column, values: set) -> Column:
    known = sorted(v for v in values if v is not None)
    match = c.isin(known) if known else F.lit(False)
    return (match | c.isNull()) if None in values else match
