"""Live event updates: filter listed events, flag first sightings, publish, consume, log.

    pages --live_payload--> updates --first_seen--> flagged --publish--> messages
    messages --consume--> parquet log, one folder per day

Both ends are Structured Streaming queries with a checkpoint: a restart goes on where the
last one stopped, with the ids seen so far, and the file sinks write each batch once.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tourlens import schemas
from tourlens.functions import dates
from tourlens.plans.staging import is_on
from tourlens.sources import landing, workspace
from tourlens.sources.tables import read_or_empty, typed_empty

# The topic, and how long a batch waits before it is written.
TOPIC = "ticket_events"
FLUSH = "10 seconds"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Updates of one event in order of sighting; what follows the time only settles ties.
SIGHTING_ORDER = (
    "observed_at", "event_status", "event_name", "artist_name", "venue_name", "event_date", "city", "country_code"
)
#: Event ids meet in shares, and within a share their state is kept in buckets: few calls to the state for many ids,
#: and little to rewrite for one. Both are part of a checkpoint, so they do not hang on the session.
SHARES, BUCKETS = 4096, 16
#: Lanes per task of a shuffle, so that lanes fill all tasks of any session about evenly.
LANES_PER_TASK = 4

# Messages carry times in ISO-8601, to the microsecond.
MESSAGE_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _lanes(spark: SparkSession) -> int:
    return LANES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- producing ------------------------------------------------------------------


def live_payload(
    pages: DataFrame,
    min_upcoming: int = landing.MIN_UPCOMING,
    countries: Sequence[str] | None = None,
    as_of: dt.date | Column | None = None,
    observed_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Listed events that pass the stream's filters, as updates.

    The stream is laxer than the batch: names are not cleaned, and neither shows nor venues
    listed as artists are looked for. A missing status reads 'unknown'.
    """
    listed = landing.listings(pages).where(
        landing.has_id(F.col("event.id"))
        & F.col("has_attraction")
        & landing.enough_upcoming(min_upcoming)
        & landing.artist_kind()
        & is_on(F.col("event.dates.status.code"))
    )
    updates = listed.select(
        F.col("event.id").alias("event_id"),
        F.col("event.name").alias("event_name"),
        F.col("attraction.name").alias("artist_name"),
        F.col("event.dates.start.localDate").alias("event_date"),
        F.coalesce("event.dates.status.code", F.lit("unknown")).alias("event_status"),
        F.col("venue.name").alias("venue_name"),
        F.col("venue.city.name").alias("city"),
        F.col("venue.country.countryCode").alias("country_code"),
        dates.moment(observed_at).alias("observed_at"),
    )
    if countries is not None:
        updates = updates.where(F.col("country_code").isin(*countries))
    if as_of is not None:
        updates = updates.where(
            dates.within_listing_window(dates.iso_date(F.col("event_date")), as_of)
        )
    return updates


def _splitter(order: list[str]):
    # Local to a function so that it travels to the executors by value.
    import pandas as pd

    def split(rows):
        """The earliest row of each id, and the later ones. Only rows that share an id are sorted."""
        shared = rows["event_id"].fillna("").duplicated(keep=False)
        if not shared.any():
            return rows, rows[:0]
        ordered = rows[shared].sort_values(order, kind="stable")
        later = ordered.duplicated("event_id")
        return pd.concat([rows[~shared], ordered[~later]]), ordered[later]

    return split


def _processor(columns: list[str], order: list[str], ttl_ms: int | None):
    # Local to a function so that the class travels to the executors by value.
    import zlib

    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    split = _splitter(order)

    class FirstSeen(StatefulProcessor):
        """Remembers, for each event id of its share, when it was first seen; gets at most a row per id and Arrow batch.

        A bucket of ids is read once in a batch, and written once if it has new ones. `until` is when an id is forgotten,
        0 for never: a bucket lives as long as its newest id.
        """

        def init(self, handle):
            self.seen = handle.getMapState(
                "first_seen_ids", "bucket INT", "event_id ARRAY<STRING>, at ARRAY<BIGINT>, until ARRAY<BIGINT>", ttl_ms
            )

        def handleInputRows(self, key, rows, timerValues):
            # A row per id is held back: the earliest so far. What came since is added when it is as much again.
            first, since = None, []
            for chunk in rows:
                since.append(chunk)
                if first is None or sum(map(len, since)) >= len(first):
                    first, later = split(chunk if first is None else pd.concat([first, *since]))
                    since = []
                    yield later.assign(is_new=False)[columns]
            if first is None:
                return
            if since:
                first, later = split(pd.concat([first, *since]))
                yield later.assign(is_new=False)[columns]
            now = timerValues.getCurrentProcessingTimeInMs() if ttl_ms else 0
            ids = first["event_id"].fillna("").tolist()
            buckets = {}
            for place, event_id in enumerate(ids):
                buckets.setdefault(zlib.crc32(event_id.encode()) % BUCKETS, []).append(place)
            times, new = first["observed_at"].tolist(), [False] * len(ids)
            for bucket, places in buckets.items():
                held = self.seen.getValue((bucket,))
                known = {i: (at, until) for i, at, until in zip(*held, strict=True) if not until or until > now} if held else {}
                for place in places:
                    if ids[place] not in known:
                        new[place] = True
                        known[ids[place]] = (times[place].value // 1000, now + ttl_ms if ttl_ms else 0)
                if any(new[place] for place in places):
                    at, until = zip(*known.values(), strict=True)
                    self.seen.updateValue((bucket,), (list(known), list(at), list(until)))
            yield first.assign(is_new=new)[columns]

        def close(self):
            pass

    return FirstSeen()


def first_seen(updates: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Flag the first update of each event id, over all batches and restarts.

    Within a batch the earliest `observed_at` counts as first. Each Arrow batch nominates its
    earliest row per id, and only nominees meet in the stateful operator, in shares by a hash of their id. All other
    rows cannot be first: they take a branch without state or shuffle, so an
    event that fills a third of the stream sends few rows to its task. Both branches nominate by themselves, so
    the rows of a batch must come in a fixed order: from a source, through steps without a shuffle. Start it in `state_store`.
    """
    order = [c for c in SIGHTING_ORDER if c in updates.columns]

    split = _splitter(order)

    def nominate(batches):
        for rows in batches:
            first, later = split(rows)
            yield first.assign(nominee=True)
            yield later.assign(nominee=False)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema)
    nominated = updates.mapInPandas(nominate, f"{fields}, nominee BOOLEAN")
    settled = (
        nominated.where("nominee")
        .drop("nominee")
        .withColumn("share", F.pmod(F.xxhash64("event_id"), F.lit(SHARES)).cast("int"))
        .groupBy("share")
        .transformWithStateInPandas(
            statefulProcessor=_processor([*updates.columns, "is_new"], order, ttl_ms),
            outputStructType=f"{fields}, is_new BOOLEAN",
            outputMode="Append",
            timeMode="ProcessingTime" if ttl_ms else "None",
        )
    )
    return settled.unionByName(nominated.where("NOT nominee").drop("nominee").withColumn("is_new", F.lit(False)))


@contextmanager
def state_store(spark: SparkSession):
    """The store that `first_seen` keeps its state in, for queries started in the block; the session's own comes back after it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def flag_first_sightings(updates: DataFrame) -> DataFrame:
    """Batch form of `first_seen`, with the same lanes: no id's rows sit in one task."""
    order = [F.col(c).asc() for c in SIGHTING_ORDER if c in updates.columns]

    def rank(lane: str) -> Column:
        return F.row_number().over(Window.partitionBy("event_id", lane).orderBy(*order))

    # Rows are dealt by their place, so updates of one event and one time spread too; the order settles which is first.
    lane = (F.pmod(F.monotonically_increasing_id(), F.lit(_lanes(updates.sparkSession))) + 1).cast("int")
    nominated = updates.withColumn("_lane", lane).withColumn("_rank", rank("_lane"))
    return (
        nominated.withColumn("_lane", F.when(F.col("_rank") == 1, 0).otherwise(F.col("_lane")))
        .withColumn("is_new", (F.col("_lane") == 0) & (rank("_lane") == 1))
        .drop("_lane", "_rank")
    )


def live_updates(pages: DataFrame, ttl_ms: int | None = None, **filters) -> DataFrame:
    """Pages to flagged updates; filters as in `live_payload`."""
    return first_seen(live_payload(pages, **filters), ttl_ms)


def as_messages(updates: DataFrame) -> DataFrame:
    return updates.select(
        F.col("event_id").cast("string").alias("key"), F.to_json(F.struct("*"), MESSAGE_FORMAT).alias("value")
    )


def publish(
    updates: DataFrame, target: str, checkpoint: str, servers: str | None = None, once: bool = False
) -> StreamingQuery:
    """Send updates as JSON messages: to topic `target` if `servers` is given, else to a folder."""
    messages = as_messages(updates)
    if servers:
        writer = messages.writeStream.format("kafka").options(
            **{"kafka.bootstrap.servers": servers, "topic": target}
        )
    else:
        writer = messages.select("value").writeStream.format("text").option("path", target)
    return _start(updates.sparkSession, writer, checkpoint, once)


# --- consuming ------------------------------------------------------------------


def read_messages(
    spark: SparkSession, source: str, servers: str | None = None, rows_per_batch: int | None = None
) -> DataFrame:
    """Messages from the start: of topic `source` if `servers` is given, else of a folder."""
    if not servers:
        return spark.readStream.schema("value STRING").text(source)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": source,
        "startingOffsets": "earliest",
    }
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """JSON text to updates; what lacks the required fields is not an update."""
    update = F.from_json("value", schemas.LIVE_UPDATES, MESSAGE_FORMAT).alias("u")
    return messages.select(update).select("u.*").where(
        F.col("event_id").isNotNull() & F.col("observed_at").isNotNull()
    )


def consume(messages: DataFrame, log: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append updates to the log, one folder per day of observation."""
    rows = parse_messages(messages).withColumn("observed_date", F.to_date("observed_at"))
    writer = (
        rows.writeStream.format("parquet").option("path", log).partitionBy("observed_date")
    )
    return _start(messages.sparkSession, writer, checkpoint, once)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log, empty if nothing was written; columns older files lack read as null."""
    return read_or_empty(spark, log, f"{schemas.LIVE_UPDATES}, observed_date DATE")


def align(table: str, stored: StructType, rows: DataFrame) -> StructType:
    """The schema of a stored table with the columns that a batch brings in addition; a column never changes its type."""
    known = {f.name: f.dataType for f in stored}
    clashing = [f.name for f in rows.schema if known.get(f.name, f.dataType) != f.dataType]
    if clashing:
        raise TypeError(f"{table}: other types than stored in {', '.join(clashing)}")
    return StructType([*stored.fields, *[f for f in rows.schema if f.name not in known]])


def append_to_table(updates: DataFrame, table: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to a stored table whose columns may grow, one folder per batch.

    Each batch starts by aligning the stored schema: columns it brings are added, and read as null in the older
    rows. A batch that is repeated after a failure overwrites its folder, so its rows are stored once.
    """

    def append(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        stored = table_schema(spark, table)
        aligned = align(table, stored, rows)
        if aligned != stored:
            workspace.delete(spark, f"{table}/_schema")
            workspace.write_text(spark, f"{table}/_schema", aligned.json())
        rows.write.mode("overwrite").parquet(f"{table}/batch={stream}-{batch:010d}")

    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    return _start(updates.sparkSession, updates.writeStream.foreachBatch(append), checkpoint, once)


def table_schema(spark: SparkSession, table: str) -> StructType:
    path = f"{table}/_schema"
    return StructType.fromJson(json.loads(workspace.read_text(spark, path))) if workspace.exists(spark, path) else StructType([])


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a table of `append_to_table`, in the schema that its batches have grown to."""
    schema = table_schema(spark, table)
    if not schema.fields:
        return typed_empty(spark, schemas.LIVE_UPDATES)
    return spark.read.schema(schema.add("batch", "string")).parquet(table).drop("batch")


def _start(spark: SparkSession, writer, checkpoint: str, once: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": FLUSH}
    with state_store(spark):
        return (
            writer.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def stop(*queries: StreamingQuery) -> None:
    """Finish the running batch of each query, then stop it."""
    for query in queries:
        if query.isActive:
            query.processAllAvailable()
            query.stop()
