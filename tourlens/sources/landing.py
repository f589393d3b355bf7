"""Landed JSON documents to flat rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.functions import dates, text
from tourlens.operators.keyed import best_per_key
from tourlens.plans.staging import is_on

# Kinds of attraction that are not artists.
NOT_ARTISTS = ("Event Style", "Venue Based")

# Fixed value: an attraction with fewer upcoming events is not touring.
MIN_UPCOMING = 3


def read_event_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EVENT_PAGE).json(path)


def stream_event_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.EVENT_PAGE).json(path)


def read_setlist_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SETLIST_PAGE).json(path)


def read_artist_searches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTIST_SEARCH).json(path)


def one_or_many(c: Column, ddl: str) -> Column:
    """JSON text that holds an object or a list of them, as an array either way."""
    return F.from_json(c, f"ARRAY<STRUCT<{ddl}>>")


# --- events -------------------------------------------------------------------


def listings(pages: DataFrame) -> DataFrame:
    """One row per listed event, with its first attraction, classification and venue."""
    events = pages.select(
        "country_order", "chunk", "page", F.posexplode("_embedded.events").alias("pos", "event")
    )
    attractions = F.col("event._embedded.attractions")
    return events.withColumns(
        {
            "attraction": F.get(attractions, F.lit(0)),
            "venue": F.get(F.col("event._embedded.venues"), F.lit(0)),
            "has_attraction": F.coalesce(F.size(attractions) > 0, F.lit(False)),
        }
    ).withColumn("kind", F.get(F.col("attraction.classifications"), F.lit(0)))


def has_id(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def enough_upcoming(minimum: int) -> Column:
    return F.coalesce(F.col("attraction.upcomingEvents._total"), F.lit(0)) >= minimum


def artist_kind() -> Column:
    return ~F.coalesce(F.col("kind.type.name"), F.lit("")).isin(*NOT_ARTISTS)


def _is_its_venue(artist: Column, venue: Column) -> Column:
    """The 'artist' is the venue itself: one normalised name contains the other."""
    return (
        (F.length(artist) > 3) & (venue != "") & (venue.contains(artist) | artist.contains(venue))
    )


def _judged_by_fields(
    pages: DataFrame,
    min_upcoming: int = MIN_UPCOMING,
    as_of: dt.date | Column | None = None,
    countries: Sequence[str] | None = None,
    extracted_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Flat event rows, judged by everything but their names."""
    start = "event.dates.start"
    status = F.coalesce(F.col("event.dates.status.code"), F.lit(""))
    venue_name = F.coalesce(F.col("venue.name"), F.lit(""))
    flat = listings(pages).select(
        "country_order",
        "chunk",
        "page",
        "pos",
        "has_attraction",
        enough_upcoming(min_upcoming).alias("has_upcoming"),
        artist_kind().alias("is_artist_kind"),
        F.col("event.id").alias("event_id"),
        F.col("event.name").alias("event_name"),
        F.col(f"{start}.localDate").alias("event_date"),
        F.col(f"{start}.localTime").alias("event_time"),
        F.try_to_timestamp(F.col(f"{start}.dateTime")).alias("event_datetime_utc"),
        text.strip_qualifier(F.coalesce(F.col("attraction.name"), F.lit(""))).alias("artist_name"),
        F.lit(None).cast("string").alias("artist_mbid"),
        F.col("venue.id").alias("venue_id"),
        venue_name.alias("venue_name"),
        F.col("venue.city.name").alias("city"),
        F.col("venue.country.countryCode").alias("country_code"),
        F.col("venue.country.name").alias("country_name"),
        status.alias("event_status"),
        F.col("event.url").alias("event_url"),
        F.nullif(F.col("kind.genre.name"), F.lit("")).alias("tm_genre"),
        F.nullif(F.col("kind.subGenre.name"), F.lit("")).alias("tm_subgenre"),
        dates.moment(extracted_at).alias("extracted_at"),
    )
    in_window, in_market = F.lit(True), F.lit(True)
    if as_of is not None:
        listed = dates.within_listing_window(dates.iso_date(F.col("event_date")), as_of)
        in_window = F.coalesce(listed, F.lit(False))
    if countries is not None:
        in_market = F.coalesce(F.col("country_code").isin(*countries), F.lit(False))
    reason = (
        F.when(~in_market, "other_market")
        .when(~in_window, "outside_window")
        .when(~F.col("has_attraction"), "no_attraction")
        .when(~F.col("has_upcoming"), "few_upcoming")
        .when(~F.col("is_artist_kind"), "not_an_artist")
        .when(~is_on(F.col("event_status")), "called_off")
        .when(~has_id(F.col("event_id")), "no_id")
    )
    return flat.withColumn("reject_reason", reason).drop(
        "has_attraction", "has_upcoming", "is_artist_kind"
    )


def _judged_by_names(events: DataFrame) -> DataFrame:
    """Also reject events whose 'artist' is the venue."""
    names = F.struct(
        text.normalise_name(F.col("artist_name")).alias("artist"),
        text.normalise_name(F.col("venue_name")).alias("venue"),
    )
    # Binding the names in a lambda evaluates them once; plain columns would be copied into
    # the filter at each of their uses, patterns and all.
    is_venue = F.exists(F.array(names), lambda n: _is_its_venue(n["artist"], n["venue"]))
    return events.withColumn(
        "reject_reason", F.coalesce("reject_reason", F.when(is_venue, "venue_as_artist"))
    )


def judged_events(pages: DataFrame, **options) -> DataFrame:
    """Every listed event as a flat row, with `reject_reason` null where it is kept.

    Options: `min_upcoming`; `as_of`, to reject listings outside the year from then on;
    `countries`, to reject other markets; `extracted_at`, the stamp of the rows.
    """
    return _judged_by_names(_judged_by_fields(pages, **options))


def kept_events(judged: DataFrame) -> DataFrame:
    """The accepted rows; of an event listed several times, the first to arrive."""
    accepted = judged.where(F.col("reject_reason").isNull())
    arrival = ["country_order", "chunk", "page", "pos"]
    first = best_per_key(accepted, ["event_id"], [F.col(c).asc() for c in arrival])
    return first.drop("reject_reason", *arrival)


def flatten_events(pages: DataFrame, **options) -> DataFrame:
    """Pages to raw event rows; options as in `judged_events`.

    The same as keeping the accepted rows of `judged_events`, but names are only compared
    where the other fields have not settled the matter.
    """
    passed = _judged_by_fields(pages, **options).where(F.col("reject_reason").isNull())
    return kept_events(_judged_by_names(passed))


# --- setlists -----------------------------------------------------------------


def flatten_setlists(
    pages: DataFrame,
    min_year: int = dates.MIN_SETLIST_YEAR,
    extracted_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Pages to raw setlist rows, songs of all sets and encores in order.

    Setlists dated before `min_year` are dropped; undated ones are kept here.
    """
    setlist = pages.select(
        "requested_artist",
        "requested_mbid",
        F.explode(one_or_many(F.col("setlist"), schemas.SETLIST)).alias("s"),
    )
    year = dates.setlist_year(F.col("s.eventDate"))
    recent = setlist.where((year.isNull() | (year >= min_year)) & has_id(F.col("s.id")))
    songs = F.flatten(
        F.transform(
            one_or_many(F.col("s.sets.set"), schemas.SETLIST_SET),
            # A set without songs must not turn the whole list null.
            lambda part: F.coalesce(
                one_or_many(part["song"], schemas.SETLIST_SONG),
                F.array().cast(f"ARRAY<STRUCT<{schemas.SETLIST_SONG}>>"),
            ),
        )
    )
    named = F.filter(songs, lambda song: F.coalesce(song["name"], F.lit("")) != "")
    return recent.withColumn(
        "songs",
        F.coalesce(F.transform(named, lambda song: text.strip(song["name"])), F.array().cast("array<string>")),
    ).select(
        F.col("s.id").alias("setlist_id"),
        F.coalesce("s.eventDate", F.lit("")).alias("event_date"),
        F.coalesce(F.nullif(F.col("s.artist.name"), F.lit("")), F.col("requested_artist")).alias(
            "artist_name"
        ),
        F.col("s.artist.mbid").alias("artist_mbid"),
        F.col("s.tour.name").alias("tour_name"),
        F.col("s.venue.name").alias("venue_name"),
        F.col("s.venue.city.name").alias("city"),
        F.col("s.venue.city.country.code").alias("country_code"),
        F.col("s.venue.city.country.name").alias("country_name"),
        F.size("songs").cast("bigint").alias("song_count"),
        text.join_songs(F.col("songs")).alias("songs_played"),
        F.col("s.versionId").alias("setlistfm_version"),
        F.try_to_timestamp(F.col("s.lastUpdated")).alias("setlistfm_last_updated"),
        F.col("s.url").alias("setlistfm_url"),
        dates.moment(extracted_at).alias("extracted_at"),
    )
