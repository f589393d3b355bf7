"""The three marts: who tours most, how repertoires change, how fresh setlists are."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourlens.functions import dates, text
from tourlens.operators.keyed import lookup
from tourlens.sources import workspace


def _with_artist(fact: DataFrame, dim: DataFrame, *columns: Column | str) -> DataFrame:
    """Fact rows with the dimension's name and genre, title-cased once per artist."""
    artists = dim.select(
        "artist_id",
        F.col("artist_name").alias("dim_name"),
        text.title_case(F.col("primary_genre")).alias("primary_genre"),
    )
    spread = F.coalesce("concert_id", F.lit(""))
    return lookup(fact, F.col("artist_id"), artists, "artist_id", spread).select(
        F.coalesce("dim_name", "artist_name").alias("artist_name"), "primary_genre", *columns
    )


def upcoming(fact: DataFrame, as_of: dt.date | Column | None) -> DataFrame:
    """Listed concerts from `as_of` on; the month bound prunes partitions of a stored fact."""
    start = dates.day(as_of)
    ahead = (F.col("source") == "ticketmaster") & (F.col("event_date") >= start)
    if "event_month" in fact.columns:
        ahead &= F.col("event_month") >= F.trunc(start, "MM")
    return fact.where(ahead)


def touring_intensity(
    fact: DataFrame, dim: DataFrame, as_of: dt.date | Column | None = None
) -> DataFrame:
    """Upcoming concerts per artist, genre and country."""
    linked = upcoming(fact, as_of).where(
        F.col("artist_id").isNotNull() & F.col("artist_name").isNotNull()
    )
    return (
        _with_artist(linked, dim, "country")
        .groupBy("artist_name", "primary_genre", "country")
        .agg(F.count("*").alias("concert_count"))
    )


def _played(fact: DataFrame, dim: DataFrame) -> DataFrame:
    played = fact.where((F.col("source") == "setlistfm") & F.col("event_date").isNotNull())
    return _with_artist(
        played, dim, F.year("event_date").cast("bigint").alias("concert_year"), "concert_id", "songs_played"
    )


def _performances(concerts: DataFrame) -> DataFrame:
    """How often each song was played, per artist, genre and year.

    Both setlist marts build on this one table. Counting starts in the map tasks, so a
    song or artist with a large share of the rows shrinks before the shuffle.
    """
    songs = concerts.where(F.col("artist_name").isNotNull()).select(
        "artist_name",
        "primary_genre",
        "concert_year",
        F.explode(text.split_songs(F.col("songs_played"))).alias("song"),
    )
    return (
        songs.withColumn("song_name", text.strip(F.col("song")))
        .where("song_name != ''")
        .groupBy("artist_name", "primary_genre", "concert_year", "song_name")
        .agg(F.count("*").alias("times"))
    )


def yearly_repertoire(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct songs and performances per artist, genre and year.

    Concerts are counted per genre but joined by artist and year only, so an artist name
    with several genres in one year gets a row for each of the counts. Song rows that meet
    several equal counts fall into one row and add up; `matches` carries that factor
    through, instead of joining every performance with every count.
    """
    concerts = _played(fact, dim)
    return _repertoire(concerts, _performances(concerts))


def _repertoire(concerts: DataFrame, performances: DataFrame) -> DataFrame:
    songs = (
        performances.groupBy("artist_name", "primary_genre", "concert_year")
        .agg(F.count("*").alias("unique_songs"), F.sum("times").alias("performances"))
    )
    counts = (
        concerts.where(F.col("artist_name").isNotNull())
        .groupBy("artist_name", "primary_genre", "concert_year")
        .agg(F.countDistinct("concert_id").alias("concert_count"))
        .groupBy("artist_name", "concert_year", "concert_count")
        .agg(F.count("*").alias("matches"))
    )
    return songs.join(counts, ["artist_name", "concert_year"]).select(
        "artist_name",
        "primary_genre",
        "concert_year",
        "concert_count",
        "unique_songs",
        (F.col("performances") * F.col("matches")).alias("total_song_performances"),
    )


def setlist_freshness(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Share of a year's songs that the artist had not played in any earlier year."""
    concerts = _played(fact, dim)
    return _freshness(concerts, _performances(concerts))


def _freshness(concerts: DataFrame, performances: DataFrame) -> DataFrame:
    # At most one row per genre and year is left of an (artist, song) group here.
    debut = Window.partitionBy("artist_name", "song_name")
    songs = performances.withColumn("first_year", F.min("concert_year").over(debut))
    fresh = songs.groupBy("artist_name", "primary_genre", "concert_year").agg(
        F.count("*").alias("unique_songs"),
        F.count_if(F.col("first_year") == F.col("concert_year")).alias("first_time_songs"),
        F.count_if(F.col("first_year") < F.col("concert_year")).alias("repeated_songs"),
    )
    counts = concerts.groupBy("artist_name", "concert_year").agg(
        F.countDistinct("concert_id").alias("concert_count")
    )
    share = F.try_divide(F.col("first_time_songs"), F.col("unique_songs"))
    return fresh.join(counts, ["artist_name", "concert_year"]).select(
        "artist_name",
        "primary_genre",
        "concert_year",
        "concert_count",
        "unique_songs",
        "first_time_songs",
        "repeated_songs",
        F.round(share * 100, 1).alias("freshness_pct"),
    )


def setlist_marts(fact: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Yearly repertoire and freshness for a reader of both: concerts and performances are made once, in scratch space."""
    concerts = _settled(_played(fact, dim), "played")
    performances = _settled(_performances(concerts), "performances")
    return _repertoire(concerts, performances), _freshness(concerts, performances)


def _settled(df: DataFrame, purpose: str) -> DataFrame:
    return workspace.settled(df, workspace.new_folder(df.sparkSession, purpose))
