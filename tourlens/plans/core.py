"""The star schema: artist dimension and concert fact, full or incremental."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.functions import dates
from tourlens.operators.keyed import best_per_key, latest_per_key, lookup
from tourlens.plans.staging import is_on
from tourlens.sources import workspace
from tourlens.sources.tables import TABLES, TableStore, typed_empty

# Artist types that are genuine performers.
ARTIST_TYPES = ("Person", "Group", "Orchestra", "Choir")

EPOCH = dt.datetime(1970, 1, 1)

Moment = dt.datetime | Column | None


def is_performer(artist_type: Column) -> Column:
    """An unknown type counts as a person."""
    return F.coalesce(artist_type, F.lit("Person")).isin(*ARTIST_TYPES)


def _performers(raw_artists: DataFrame) -> DataFrame:
    return raw_artists.where(F.col("mbid").isNotNull() & is_performer(F.col("artist_type")))


def artists_combined(raw_artists: DataFrame, raw_events: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """The newest record of each artist, else the name of its newest event.

    `known_ids` (mbid) are artists with a record, if `raw_artists` does not hold them all.
    """
    known = latest_per_key(
        _performers(raw_artists).select(
            F.col("mbid").cast("string").alias("mbid"),
            F.col("artist_name").cast("string").alias("artist_name"),
            F.col("primary_genre").cast("string").alias("primary_genre"),
            F.col("extracted_at").cast("timestamp").alias("extracted_at"),
        ),
        ["mbid"],
        ties=["artist_name", "primary_genre"],
    )
    seen = latest_per_key(
        raw_events.where(F.col("artist_mbid").isNotNull()).select(
            F.col("artist_mbid").alias("mbid"),
            "artist_name",
            F.col("extracted_at").cast("timestamp").alias("extracted_at"),
            "event_id",
        ),
        ["mbid"],
        ties=["event_id", "artist_name"],
    )
    fallback = seen.join(known if known_ids is None else known_ids, "mbid", "left_anti").select(
        "mbid", "artist_name", F.lit(None).cast("string").alias("primary_genre"), "extracted_at"
    )
    return known.unionByName(fallback)


def dim_artist(raw_artists: DataFrame, raw_events: DataFrame, loaded_at: Moment = None) -> DataFrame:
    return _as_dim(artists_combined(raw_artists, raw_events), loaded_at)


def _as_dim(artists: DataFrame, loaded_at: Moment, *more: str) -> DataFrame:
    return artists.select(
        F.col("mbid").alias("artist_id"),
        "mbid",
        "artist_name",
        "primary_genre",
        dates.moment(loaded_at).alias("_loaded_at"),
        *more,
    )


def fact_concert(unified: DataFrame, dim: DataFrame, loaded_at: Moment = None, *more: str) -> DataFrame:
    """Concerts linked to the dimension, with the month they are partitioned by and, if asked, `more` columns."""
    artists = dim.select(
        F.col("mbid").alias("dim_mbid"), "artist_id", F.col("artist_name").alias("dim_name")
    )
    linked = lookup(
        unified, F.col("artist_mbid"), artists, "dim_mbid", F.coalesce("concert_id", F.lit(""))
    )
    return linked.select(
        "concert_id",
        "artist_id",
        F.coalesce("dim_name", "artist_name").alias("artist_name"),
        "event_date",
        "country",
        "city",
        "venue_name",
        "event_status",
        "setlist_id",
        "songs_played_count",
        "songs_played",
        "tour_id",
        "source",
        dates.moment(loaded_at).alias("loaded_at"),
        F.trunc("event_date", "MM").alias("event_month"),
        *more,
    )


# --- incremental loads --------------------------------------------------------
#
# By default a load remembers the newest `extracted_at` it has seen and takes everything
# from there on, besides all keys it has not stored yet, however late they come; the keyed
# merge makes taking a row twice harmless. The two are separate branches: the watermark is
# a filter of the scan, and late rows are found by their keys alone. With `strict_reference`
# a load compares `extracted_at` with the time of the last load instead, which loses late
# rows and, for the fact, loads nothing into an empty table.


def _newest(df: DataFrame, column: str):
    return df.agg(F.max(column)).first()[0]


def _mark(store: TableStore, table: str):
    return _newest(store.read(f"{table}_watermark"), "extracted_at")


def _is_new(mark) -> Column:
    # Rows without a stamp cannot be told old from new, so they are always taken.
    at = F.col("extracted_at")
    return F.lit(True) if mark is None else (at >= F.lit(mark)) | at.isNull()


def due(rows: DataFrame, key: str, stored: DataFrame, mark, more: DataFrame | None = None) -> DataFrame:
    """Rows that a load has to take: stamped since `mark`, or of a key that is not stored yet or in `more`.

    The first branch is a filter of the scan; of older rows only keys are compared with the
    stored ones (one column of that name), and whole rows are read for the keys that are left.
    """
    if mark is None:
        return rows
    older = rows.where(F.col("extracted_at") < F.lit(mark))
    keys = older.select(key).join(stored.select(key), key, "left_anti")
    if more is not None:
        keys = keys.union(more.select(key))
    return rows.where(_is_new(mark)).unionByName(older.join(keys.distinct(), key, "left_semi"))


def _stored(store: TableStore, table: str, rows: DataFrame, rebuild: bool, removed: DataFrame | None = None) -> DataFrame:
    """Store rows that also have `extracted_at`, and remember the newest: rows are made once, then read from scratch space."""
    with workspace.staged(rows, f"load-{table}") as rows:
        newest, mark = _newest(rows, "extracted_at"), f"{table}_watermark"
        columns = rows.select(*typed_empty(store.spark, TABLES[table].ddl).columns)
        result = store.overwrite(table, columns) if rebuild else store.upsert(table, columns, removed, settled=True)
        if newest is not None:
            new = store.spark.createDataFrame([(newest,)], "extracted_at TIMESTAMP")
            store.overwrite(mark, store.read(mark).unionByName(new).agg(F.max("extracted_at").alias("extracted_at")))
    return result


def load_dim_artist(
    store: TableStore,
    raw_artists: DataFrame,
    raw_events: DataFrame,
    loaded_at: Moment = None,
    full_refresh: bool = False,
    strict_reference: bool = False,
) -> DataFrame:
    """Merge artists into the stored dimension."""
    rebuild = full_refresh or not store.exists("dim_artist")
    if rebuild:
        rows = artists_combined(raw_artists, raw_events)
    elif strict_reference:
        mark = _newest(store.read("dim_artist"), "_loaded_at") or EPOCH
        rows = artists_combined(raw_artists, raw_events).where(F.col("extracted_at") > F.lit(mark))
    else:
        stored, mark = store.read("dim_artist").select("mbid"), _mark(store, "dim_artist")
        events = raw_events.where(F.col("artist_mbid").isNotNull())
        rows = artists_combined(
            due(_performers(raw_artists), "mbid", stored, mark),
            due(events, "artist_mbid", stored.select(F.col("mbid").alias("artist_mbid")), mark),
            _performers(raw_artists).select("mbid"),
        )
    return _stored(store, "dim_artist", _as_dim(rows, loaded_at, "extracted_at"), rebuild)


def _stored_concerts(store: TableStore) -> tuple[DataFrame, DataFrame]:
    """Ids of the stored concerts, and of those without an artist."""
    stored = store.read("fact_concert")
    return stored.select("concert_id"), stored.where(F.col("artist_id").isNull()).select("concert_id")


def due_concerts(store: TableStore, raw_events: DataFrame, raw_setlists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The raw rows that `load_fact_concert` needs: new ones, late ones, and those of concerts without an artist.

    Raw tables hold each key once, so a row is all there is of its concert.
    """
    mark = _mark(store, "fact_concert") if store.exists("fact_concert") else None
    if mark is None:
        return raw_events, raw_setlists
    stored, unlinked = _stored_concerts(store)

    def taken(raw: DataFrame, key: str) -> DataFrame:
        ids = [df.select(F.col("concert_id").alias(key)) for df in (stored, unlinked)]
        return due(raw, key, ids[0], mark, ids[1])

    return taken(raw_events, "event_id"), taken(raw_setlists, "setlist_id")


def load_fact_concert(
    store: TableStore,
    unified: DataFrame,
    dim: DataFrame,
    loaded_at: Moment = None,
    full_refresh: bool = False,
    strict_reference: bool = False,
    removed: DataFrame | None = None,
    taken: bool = False,
) -> DataFrame:
    """Merge concerts into the stored fact.

    `unified` holds all concerts, or only those staged from `due_concerts` if they are `taken` already.
    `removed` (concert_id) deletes concerts that have since been called off; without it
    they stay. By default, concerts stored before their artist was known are linked again.
    """
    rebuild = full_refresh or not store.exists("fact_concert")
    mark = None if rebuild or strict_reference else _mark(store, "fact_concert")
    if mark is not None:
        stored, unlinked = _stored_concerts(store)
    if mark is not None and not taken:
        unified = due(unified, "concert_id", stored, mark, unlinked)
    rows = best_per_key(
        unified, ["concert_id"], [F.col("extracted_at").desc_nulls_last(), F.col("source").asc()]
    )
    if strict_reference and not rebuild:
        last = _newest(store.read("fact_concert"), "loaded_at")
        rows = rows.where(F.lit(False) if last is None else F.col("extracted_at") > F.lit(last))
    elif mark is not None:
        # A stored concert without an artist is taken again only if it links now.
        known = dim.select(F.col("mbid").alias("_mbid"), F.lit(True).alias("_known"))
        again = rows.join(unlinked.withColumn("_again", F.lit(True)), "concert_id", "left")
        again = lookup(again, F.col("artist_mbid"), known, "_mbid", F.coalesce("concert_id", F.lit("")))
        rows = again.where(_is_new(mark) | F.col("_again").isNull() | F.coalesce("_known", F.lit(False))).select(*rows.columns)
    if removed is not None:
        rows = rows.join(removed, "concert_id", "left_anti")
    return _stored(store, "fact_concert", fact_concert(rows, dim, loaded_at, "extracted_at"), rebuild, removed)


def called_off(raw_events: DataFrame) -> DataFrame:
    """Ids of events whose newest record says they are off, for `load_fact_concert(removed=…)`."""
    newest = latest_per_key(raw_events, ["event_id"], ties=["event_status"])
    return newest.where(~is_on(F.col("event_status"))).select(F.col("event_id").alias("concert_id"))
