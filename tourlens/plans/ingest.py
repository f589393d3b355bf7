"""From landed documents to the three raw tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.functions import dates, text
from tourlens.operators import matching
from tourlens.operators.keyed import latest_per_key
from tourlens.sources import landing, workspace
from tourlens.sources.tables import RAW_TABLES, TABLES, TableStore

# The modes, the tracked artists of the small one, how long the list of most
# active artists is, and the markets.
MODES = ("prototype", "production")
TRACKED_ARTISTS = "Coldplay,Radiohead,Arctic Monkeys"
MAX_ARTISTS = 120
COUNTRIES = ("US", "CA", "GB", "DE", "IT")


def touring_candidates(events: DataFrame, max_artists: int = MAX_ARTISTS) -> DataFrame:
    """The artists with most events over all markets, names that look like shows left out."""
    named = events.where(~text.is_non_artist(F.col("artist_name")))
    return top_touring(named, max_artists)


def top_touring(events: DataFrame, max_artists: int | None = None) -> DataFrame:
    """Events by artist; the most active `max_artists` if a number is given, else all."""
    counts = (
        events.select(text.strip(F.col("artist_name")).alias("artist_name"))
        .where("artist_name != ''")
        .groupBy("artist_name")
        .agg(F.count("*").alias("event_count"))
    )
    if max_artists is None:
        return counts
    return counts.orderBy(F.desc("event_count"), "artist_name").limit(max_artists)


@dataclass(frozen=True)
class Ingested:
    events: DataFrame
    setlists: DataFrame
    artists: DataFrame
    cache: DataFrame  # new entries of `artist_resolution`
    judged_events: DataFrame
    judged_artists: DataFrame
    scratch: str | None  # where the shared steps were written

    def __enter__(self) -> Ingested:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Drop the shared steps; the frames cannot be read any more."""
        if self.scratch:
            workspace.delete(self.events.sparkSession, self.scratch)

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(RAW_TABLES, (self.events, self.setlists, self.artists)))

    def metrics(self) -> DataFrame:
        """Kept and rejected rows by reason, for events and artists."""
        return (
            matching.count_by_reason(self.judged_events)
            .withColumn("stage", F.lit("events"))
            .unionByName(
                matching.count_by_reason(self.judged_artists, "verified").withColumn(
                    "stage", F.lit("artists")
                )
            )
            .select("stage", "outcome", "n")
        )


def ingest(
    event_pages: DataFrame,
    setlist_pages: DataFrame,
    searches: DataFrame,
    cache: DataFrame,
    mode: str = "prototype",
    tracked: DataFrame | None = None,
    min_upcoming: int = landing.MIN_UPCOMING,
    max_artists: int | None = None,
    countries: Sequence[str] = COUNTRIES,
    as_of: dt.date | Column | None = None,
    extracted_at: dt.datetime | Column | None = None,
    stored_setlists: DataFrame | None = None,
    keep_scratch: bool = False,
) -> Ingested:
    """Flatten, filter, resolve, verify and enrich.

    All outputs build on the judged and the kept events and the resolved artists. Each is written to
    the shared scratch folder once, so that no page is parsed, no event sorted and no name matched again for
    each output. Use the result in a `with` block to drop them afterwards, unless
    `keep_scratch` leaves that to the cleaner of the folder.

    `prototype` follows `tracked` (artist_name, position), `production` all artists with events, or
    the `max_artists` most active ones; both in the markets of `countries`. With `stored_setlists`, artists
    who have any stored setlist are skipped; the keyed merge makes that optional.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    production = mode == "production"
    if not production and tracked is None:
        raise ValueError("prototype mode needs the tracked artists")
    judged = landing.judged_events(
        event_pages,
        min_upcoming=min_upcoming,
        as_of=as_of,
        countries=countries,
        extracted_at=extracted_at,
    )
    scratch = workspace.new_folder(judged.sparkSession, "ingest")
    judged = workspace.settled(judged, f"{scratch}/judged")
    events = landing.kept_events(judged)
    if production:
        shows = F.col("reject_reason").isNull() & text.is_non_artist(F.col("artist_name"))
        judged = judged.withColumn(
            "reject_reason", F.when(shows, "show_name").otherwise(F.col("reject_reason"))
        )
        events = events.where(~text.is_non_artist(F.col("artist_name")))
    events = workspace.settled(events, f"{scratch}/events")
    if production:
        names = top_touring(events, max_artists).select(
            "artist_name", (-F.col("event_count")).alias("position")
        )
    else:
        names = tracked

    resolved = workspace.settled(
        matching.resolve_artists(names, searches, cache), f"{scratch}/resolved"
    )
    judged_artists = matching.verify_artists(resolved)
    artists = matching.verified(judged_artists)
    followed = artists if stored_setlists is None else matching.without_setlists(artists, stored_setlists)
    pages = setlist_pages.join(
        followed.select(F.col("mbid").alias("requested_mbid")).distinct(), "requested_mbid", "left_semi"
    )
    stamp = dates.moment(extracted_at)
    return Ingested(
        events=matching.with_artist_id(events, artists),
        setlists=landing.flatten_setlists(pages, extracted_at=extracted_at),
        artists=matching.artist_rows(resolved, F.date_trunc("DAY", stamp)),
        cache=matching.new_cache_entries(resolved),
        judged_events=judged,
        judged_artists=judged_artists,
        scratch=None if keep_scratch else scratch,
    )


def write(store: TableStore, result: Ingested) -> None:
    """Merge the raw tables and the resolution cache by key."""
    for name, rows in result.tables().items():
        key = TABLES[name].key
        ties = [c for c in ("artist_name", "venue_name", "event_date") if c in rows.columns]
        store.upsert(name, latest_per_key(rows.where(F.col(key[0]).isNotNull()), key, ties=ties))
    store.upsert("artist_resolution", result.cache)


def dry_run(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of what would be written."""
    counts = [df.agg(F.count("*").alias("n")).withColumn("table_name", F.lit(t)) for t, df in tables.items()]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total.select("table_name", "n")
