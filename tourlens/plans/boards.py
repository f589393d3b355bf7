"""Result sets of the dashboard.

Rankings are taken over whole marts and only then limited. Where a limit stands, it is the
result: so many rows are shown.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourlens.functions.dates import moment
from tourlens.plans.marts import upcoming

# How many rows the tiles show, and the shows that make a year count.
TOURING_ROWS, PAIR_ROWS, LIVE_ROWS = 500, 5000, 500
TOP_ARTISTS, TOP_GENRES, RECENT = 15, 10, 20
MIN_SHOWS = 5

PAIR = ("artist_a", "artist_b", "shared_venues", "jaccard_similarity")


def upcoming_date_range(fact: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    return upcoming(fact, as_of).agg(
        F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date")
    )


def date_caption(date_range: DataFrame) -> DataFrame:
    shown = [F.date_format(c, "dd/MM/yyyy").alias(c) for c in ("min_date", "max_date")]
    return date_range.select(*shown)


def top_touring_rows(touring: DataFrame, n: int = TOURING_ROWS) -> DataFrame:
    return touring.orderBy(F.desc("concert_count"), "artist_name", "primary_genre", "country").limit(n)


def top_artists(touring: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    return (
        touring.groupBy("artist_name")
        .agg(F.sum("concert_count").alias("concert_count"))
        .orderBy(F.desc("concert_count"), "artist_name")
        .limit(n)
    )


def top_artists_by_country(touring: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """Country split of the top artists."""
    top = top_artists(touring, n).select("artist_name")
    return (
        touring.join(top, "artist_name", "left_semi")
        .groupBy("artist_name", "country")
        .agg(F.sum("concert_count").alias("concert_count"))
    )


def top_genres(touring: DataFrame, n: int = TOP_GENRES) -> DataFrame:
    return (
        touring.where(F.col("primary_genre").isNotNull())
        .groupBy("primary_genre")
        .agg(F.sum("concert_count").alias("concert_count"))
        .orderBy(F.desc("concert_count"), "primary_genre")
        .limit(n)
    )


def evolution_snapshot(mart: DataFrame) -> DataFrame:
    """A setlist mart by artist and year, whole."""
    return mart.where(F.col("artist_name").isNotNull()).orderBy("artist_name", "concert_year")


def top_pairs(edges: DataFrame, n: int = PAIR_ROWS) -> DataFrame:
    return (
        edges.select(*PAIR)
        .orderBy(F.desc("jaccard_similarity"), "artist_a", "artist_b")
        .limit(n)
    )


def all_artists(repertoire: DataFrame, freshness: DataFrame) -> DataFrame:
    names = repertoire.select("artist_name").union(freshness.select("artist_name"))
    return names.where(F.col("artist_name").isNotNull()).distinct().orderBy("artist_name")


def _busy_years(mart: DataFrame, min_shows: int) -> DataFrame:
    return mart.where(F.col("artist_name").isNotNull() & (F.col("concert_count") >= min_shows))


def artist_evolution(
    repertoire: DataFrame,
    freshness: DataFrame,
    artist: str | None = None,
    min_shows: int = MIN_SHOWS,
) -> DataFrame:
    """Songs and freshness by year for one artist, or for all.

    Freshness is left out in an artist's first year with enough shows, where it says little.
    """
    if artist is not None:
        repertoire = repertoire.where(F.col("artist_name") == artist)
        freshness = freshness.where(F.col("artist_name") == artist)
    # An artist has a row per genre and calendar year: a small window whoever it is.
    first = F.min("concert_year").over(Window.partitionBy("artist_name"))
    later = (
        _busy_years(freshness, min_shows)
        .withColumn("first_year", first)
        .where(F.col("concert_year") > F.col("first_year"))
        .select(
            "artist_name",
            "concert_year",
            F.col("primary_genre").alias("later_genre"),
            "first_time_songs",
            "repeated_songs",
            "freshness_pct",
        )
    )
    years = _busy_years(repertoire, min_shows)
    # Artist and year fan out by a few genres at most; the genre, which may be null, decides.
    same = F.col("primary_genre").eqNullSafe(F.col("later_genre"))
    fresh = F.when(same, F.struct("first_time_songs", "repeated_songs", "freshness_pct"))
    keys = [*years.columns]
    return (
        years.join(later, ["artist_name", "concert_year"], "left")
        .groupBy(*keys)
        .agg(F.max(fresh).alias("fresh"))
        .select(*keys, "fresh.*")
        .orderBy("artist_name", "concert_year", "primary_genre", "concert_count")
    )


def artist_totals(
    repertoire: DataFrame, artist: str | None = None, min_shows: int = MIN_SHOWS
) -> DataFrame:
    years = _busy_years(repertoire, min_shows)
    if artist is not None:
        years = years.where(F.col("artist_name") == artist)
    return years.groupBy("artist_name").agg(
        F.min("primary_genre").alias("primary_genre"),
        F.count("*").alias("total_years"),
        F.sum("unique_songs").alias("total_unique"),
        F.sum("total_song_performances").alias("total_performances"),
    )


# --- live log -----------------------------------------------------------------


def live_metrics(live: DataFrame) -> DataFrame:
    return live.agg(
        F.countDistinct("event_id").alias("events_tracked"),
        F.countDistinct(F.when(F.col("is_new"), F.col("event_id"))).alias("new_listings"),
        F.max("observed_at").alias("latest_update"),
    )


def live_status_breakdown(live: DataFrame) -> DataFrame:
    return (
        live.where(F.col("event_status").isNotNull())
        .groupBy("event_status")
        .agg(F.countDistinct("event_id").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_status")
    )


def live_snapshot(live: DataFrame, n: int = LIVE_ROWS) -> DataFrame:
    return live.orderBy(F.desc("observed_at"), "event_id", "event_status").limit(n)


def live_recent(live: DataFrame, n: int = RECENT) -> DataFrame:
    """The newest updates, under the names they are shown with."""
    return live_snapshot(live, n).select(
        F.col("artist_name").alias("Artist"),
        F.col("event_name").alias("Event"),
        F.col("event_status").alias("Status"),
        F.col("city").alias("City"),
        F.col("country_code").alias("Country"),
        F.date_format("observed_at", "HH:mm dd/MM").alias("Observed"),
    )


def is_live(live: DataFrame, now: dt.datetime | Column, within_seconds: int = 600) -> DataFrame:
    """Has anything been observed lately?"""
    age = F.unix_timestamp(moment(now)) - F.unix_timestamp(F.max("observed_at"))
    return live.agg(F.coalesce(age <= within_seconds, F.lit(False)).alias("is_live"))
