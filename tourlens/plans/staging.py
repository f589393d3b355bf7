"""Raw tables to typed, de-duplicated concerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.functions import dates, text
from tourlens.operators.keyed import best_per_key, lookup

# Statuses of events that will not take place as listed.
OFF_STATUSES = ("cancelled", "postponed")


def is_on(status: Column) -> Column:
    """Not cancelled or postponed; an unknown status counts as on."""
    return ~F.coalesce(status, F.lit("")).isin(*OFF_STATUSES)


def _artists_by_name(raw_artists: DataFrame) -> DataFrame:
    """The newest artist record of each name key.

    An event keeps one match only, the newest, so choosing it before the join gives the
    same rows without multiplying events by namesakes.
    """
    named = raw_artists.select(
        text.name_key(F.col("artist_name")).alias("name_key"),
        F.col("mbid").alias("matched_mbid"),
        F.col("extracted_at").alias("matched_at"),
    ).where(F.col("name_key").isNotNull())
    return best_per_key(
        named,
        ["name_key"],
        [F.col("matched_at").desc_nulls_last(), F.col("matched_mbid").asc_nulls_last()],
    )


def _with_name_match(raw_events: DataFrame, raw_artists: DataFrame) -> DataFrame:
    return lookup(
        raw_events,
        text.name_key(F.col("artist_name")),
        _artists_by_name(raw_artists),
        "name_key",
        F.coalesce(F.col("event_id"), F.lit("")),
    )


def _match_order() -> list[Column]:
    """Newest match first; what follows only settles ties."""
    return [
        F.col("matched_at").desc_nulls_last(),
        F.col("matched_mbid").asc_nulls_last(),
        F.col("extracted_at").desc_nulls_last(),
        F.xxhash64("artist_name", "venue_name", "event_date", "event_status").asc(),
    ]


def stg_events(raw_events: DataFrame, raw_artists: DataFrame) -> DataFrame:
    """One row per event that is on, with an artist id from the event or from its name."""
    matched = _with_name_match(raw_events.where(is_on(F.col("event_status"))), raw_artists)
    one_each = best_per_key(
        matched, ["event_id"], [F.col("artist_mbid").isNull().asc(), *_match_order()]
    )
    return one_each.select(
        F.col("event_id").cast("string").alias("concert_id"),
        F.coalesce("artist_mbid", "matched_mbid").cast("string").alias("artist_mbid"),
        F.col("artist_name").cast("string").alias("artist_name"),
        F.col("venue_id").cast("string").alias("venue_id"),
        F.col("venue_name").cast("string").alias("venue_name"),
        F.col("city").cast("string").alias("city"),
        dates.iso_date(F.col("event_date")).alias("event_date"),
        F.col("country_code").cast("string").alias("country"),
        F.col("event_status").cast("string").alias("event_status"),
        F.col("extracted_at").cast("timestamp").alias("extracted_at"),
    )


def stg_setlists(raw_setlists: DataFrame) -> DataFrame:
    """Setlists with a readable date from the first kept day on."""
    dated = raw_setlists.withColumn("event_date", dates.mixed_date(F.col("event_date")))
    return dated.where(F.col("event_date") >= F.lit(dates.MIN_SETLIST_DATE)).select(
        F.col("setlist_id").cast("string").alias("setlist_id"),
        F.col("artist_mbid").cast("string").alias("artist_mbid"),
        F.col("artist_name").cast("string").alias("artist_name"),
        "event_date",
        F.col("country_code").cast("string").alias("country"),
        F.col("city").cast("string").alias("city"),
        F.col("venue_name").cast("string").alias("venue_name"),
        F.col("song_count").cast("bigint").alias("songs_played_count"),
        F.col("songs_played").cast("string").alias("songs_played"),
        F.col("tour_name").cast("string").alias("tour_id"),
        F.col("extracted_at").cast("timestamp").alias("extracted_at"),
    )


def concerts_unified(events: DataFrame, setlists: DataFrame) -> DataFrame:
    """Upcoming events and past setlists as one table, tagged by source."""
    shared = ["artist_mbid", "artist_name", "event_date", "country", "city", "venue_name"]
    nothing = F.lit(None)
    upcoming = events.select(
        "concert_id",
        *shared,
        "event_status",
        nothing.cast("string").alias("setlist_id"),
        nothing.cast("bigint").alias("songs_played_count"),
        nothing.cast("string").alias("songs_played"),
        nothing.cast("string").alias("tour_id"),
        F.lit("ticketmaster").alias("source"),
        "extracted_at",
    )
    played = setlists.select(
        F.col("setlist_id").alias("concert_id"),
        *shared,
        nothing.cast("string").alias("event_status"),
        "setlist_id",
        "songs_played_count",
        "songs_played",
        "tour_id",
        F.lit("setlistfm").alias("source"),
        "extracted_at",
    )
    return upcoming.unionByName(played)


def concerts_checkpoint_view(
    raw_events: DataFrame, raw_artists: DataFrame, ingested_at: dt.datetime | Column | None = None
) -> DataFrame:
    """The orchestrator's early view: every status, and the id only from the name match."""
    one_each = best_per_key(_with_name_match(raw_events, raw_artists), ["event_id"], _match_order())
    return one_each.select(
        F.col("event_id").alias("concert_id"),
        F.col("matched_mbid").alias("artist_mbid"),
        "venue_id",
        dates.iso_date(F.col("event_date")).alias("event_date"),
        F.col("country_code").alias("country"),
        F.lit(None).cast("double").alias("ticket_price_min_gbp"),
        F.lit(None).cast("double").alias("ticket_price_max_gbp"),
        "event_status",
        dates.moment(ingested_at).alias("ingested_at"),
    )
