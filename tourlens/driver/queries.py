"""Every query over the given tables: name -> function of (spark, folder)."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.driver.tables import AS_OF, LOADED_AT, Given, once
from tourlens.functions import text
from tourlens.operators import matching, quality
from tourlens.operators.keyed import latest_per_key
from tourlens.plans import boards, core, export, ingest, marts, similarity, staging
from tourlens.sources import landing, workspace
from tourlens.sources.tables import TableStore, typed_empty
from tourlens.streaming import live

QUERIES = {}

# How documents are landed: compressed, in files small enough that each is a fair share of a task.
LANDED = {"compression": "lz4", "maxRecordsPerFile": 50_000}


def query(make):
    @functools.wraps(make)
    def run(spark, sf_dir):
        return make(Given(spark, sf_dir))

    QUERIES[make.__name__] = run
    return run


def readable(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that comparisons do not hang on time zones."""
    return df.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns}
    )


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """Written once, for queries that read it several times."""
    return workspace.settled(df, workspace.new_folder(df.sparkSession, purpose))


# --- staging and core -------------------------------------------------------------


@query
def stg_events(g):
    rows = staging.stg_events(g.raw_events(copies=True), g.raw_artists(namesakes=True))
    return readable(rows, "extracted_at")


@query
def stg_setlists(g):
    return readable(staging.stg_setlists(g.raw_setlists(mixed_dates=True)), "extracted_at")


@once
def _unified(g):
    return staging.concerts_unified(
        staging.stg_events(g.raw_events(), g.raw_artists()), staging.stg_setlists(g.raw_setlists())
    )


@query
def concerts_unified(g):
    return readable(_unified(g), "extracted_at")


@once
def _dim(g):
    return core.dim_artist(g.raw_artists(), g.raw_events(), LOADED_AT)


@query
def dim_artist(g):
    return core.dim_artist(g.raw_artists(namesakes=True), g.raw_events(), LOADED_AT).drop("_loaded_at")


@once
def _fact(g):
    return core.fact_concert(_unified(g), _dim(g), LOADED_AT)


@query
def fact_concert(g):
    return _fact(g).drop("loaded_at")


@query
def checkpoint_view(g):
    rows = staging.concerts_checkpoint_view(g.raw_events(copies=True), g.raw_artists(namesakes=True))
    return rows.drop("ingested_at")


# --- marts ------------------------------------------------------------------------


@query
def touring_intensity(g):
    return marts.touring_intensity(_fact(g), _dim(g), AS_OF)


@query
def yearly_repertoire(g):
    return marts.yearly_repertoire(_fact(g), _dim(g))


@query
def setlist_freshness(g):
    return marts.setlist_freshness(_fact(g), _dim(g))


@query
def venue_similarity(g):
    return similarity.venue_similarity(g.visits())


# --- boards -----------------------------------------------------------------------


@query
def top_touring_rows(g):
    return boards.top_touring_rows(marts.touring_intensity(_fact(g), _dim(g), AS_OF))


@query
def top_artists(g):
    return boards.top_artists(marts.touring_intensity(_fact(g), _dim(g), AS_OF))


@query
def top_artists_by_country(g):
    return boards.top_artists_by_country(marts.touring_intensity(_fact(g), _dim(g), AS_OF))


@query
def top_genres(g):
    return boards.top_genres(marts.touring_intensity(_fact(g), _dim(g), AS_OF))


@query
def upcoming_date_range(g):
    return boards.upcoming_date_range(_fact(g), AS_OF)


@query
def evolution_snapshot(g):
    return boards.evolution_snapshot(marts.setlist_freshness(_fact(g), _dim(g)))


@query
def artist_evolution(g):
    return boards.artist_evolution(*marts.setlist_marts(_fact(g), _dim(g)), min_shows=2)


@query
def artist_totals(g):
    return boards.artist_totals(marts.yearly_repertoire(_fact(g), _dim(g)), min_shows=2)


@query
def all_artists(g):
    return boards.all_artists(*marts.setlist_marts(_fact(g), _dim(g)))


@query
def similarity_top_pairs(g):
    return boards.top_pairs(similarity.venue_similarity(g.visits(), with_detail=False))


@query
def similar_artists_top10(g):
    return similarity.top_similar(g.visits())


@query
def similar_to_artist(g):
    edges = similarity.venue_similarity(g.visits(), with_detail=False)
    return similarity.similar_to(edges, "Supplier#000000001")


# --- live log ---------------------------------------------------------------------


@query
def live_metrics(g):
    return readable(boards.live_metrics(g.live_log()), "latest_update")


@query
def live_status_breakdown(g):
    return boards.live_status_breakdown(g.live_log())


@query
def live_recent(g):
    return boards.live_recent(g.live_log())


@query
def json_props(g):
    return g.table("events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query
def stream_first_seen(g):
    """The events table as a stream: flag, publish as JSON, consume, log; then the log."""
    folder = workspace.new_folder(g.spark, "stream")
    flagged = live.first_seen(g.as_updates(g.table_stream("events")))
    live.publish(flagged, f"{folder}/topic", f"{folder}/published", once=True).awaitTermination()
    messages = live.read_messages(g.spark, f"{folder}/topic")
    live.consume(messages, f"{folder}/log", f"{folder}/consumed", once=True).awaitTermination()
    log = live.read_log(g.spark, f"{folder}/log")
    return readable(log, "observed_at").select("event_id", "event_status", "observed_at", "is_new")


@query
def live_payload_stream(g):
    """Landed event pages as a stream, stopped and resumed: the listings, then late ones of the same events."""
    folder = workspace.new_folder(g.spark, "live")
    for place in (0, 1):
        g.event_page_texts(place).write.mode("append").options(**LANDED).text(f"{folder}/pages")
        stream = landing.stream_event_pages(g.spark, f"{folder}/pages")
        flagged = live.live_updates(stream, observed_at=LOADED_AT)
        live.publish(flagged, f"{folder}/topic", f"{folder}/published", once=True).awaitTermination()
        messages = live.read_messages(g.spark, f"{folder}/topic")
        live.consume(messages, f"{folder}/log", f"{folder}/consumed", once=True).awaitTermination()
    log = live.read_log(g.spark, f"{folder}/log").drop("observed_date")
    return readable(log, "observed_at")


@query
def stream_table_grows(g):
    """Updates without a city, then such with one: the stored table gains the column."""
    folder, updates = workspace.new_folder(g.spark, "grows"), g.as_updates(g.table("events"))
    updates = updates.select("event_id", "event_status", "observed_at", "city")
    early = F.col("event_status") < "m"
    for rows in (updates.where(early).drop("city"), updates.where(~early)):
        rows.write.mode("overwrite").parquet(f"{folder}/in")
        stream = g.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        live.append_to_table(stream, f"{folder}/table", f"{folder}/state", once=True).awaitTermination()
    return readable(live.read_table(g.spark, f"{folder}/table"), "observed_at")


# --- landed documents and entity resolution -----------------------------------------


@query
def flatten_events(g):
    rows = landing.flatten_events(
        g.event_pages(), as_of=AS_OF, countries=[f"NATION_{i}" for i in range(20)]
    )
    shown = "event_id event_name event_date artist_name venue_name city country_code event_status".split()
    utc = F.to_utc_timestamp("event_datetime_utc", F.current_timezone())
    return readable(rows.withColumn("event_datetime_utc", utc), "event_datetime_utc").select(
        *shown, "event_datetime_utc", "tm_genre", "tm_subgenre"
    )


@query
def event_outcomes(g):
    return matching.count_by_reason(landing.judged_events(g.event_pages()))


@query
def outcomes_without_ids(g):
    """Judged events of which some came without an id."""
    events = F.transform(
        "_embedded.events", lambda e: e.withField("id", F.when(e["id"].cast("bigint") % 5 == 0, "").when(e["id"].cast("bigint") % 5 == 1, None).otherwise(e["id"]))
    )
    pages = g.event_pages().withColumn("_embedded", F.col("_embedded").withField("events", events))
    return matching.count_by_reason(landing.judged_events(pages))


@query
def show_names(g):
    """Which names read like shows: customers billed as several kinds of act."""
    acts = [" on Ice", ": The Musical", " LIVE – one night", " and Friends", " (a Tribute)", " Legacy Band", ""]
    act = F.get(F.array(*map(F.lit, acts)), (F.col("c_custkey") % len(acts)).cast("int"))
    name = F.when(F.col("c_custkey") % 10 == 0, "The Sound of ").otherwise("")
    names = g.table("customer").select("c_custkey", F.concat(name, "c_name", act).alias("artist_name"))
    return names.withColumn("is_show", text.is_non_artist(F.col("artist_name")))


@query
def similarity_of_named_venues(g):
    """Similarity where some visits have a blank venue or none: those join nobody."""
    key = F.regexp_extract("venue_name", "[0-9]+", 0).cast("bigint")
    named = F.when(key % 7 == 0, "  ").when(key % 7 != 1, F.concat(F.lit(" "), "venue_name"))
    return similarity.venue_similarity(g.visits().withColumn("venue_name", named), with_detail=False)


@query
def flatten_setlists(g):
    rows = landing.flatten_setlists(g.setlist_pages())
    return rows.drop("extracted_at", "setlistfm_last_updated", "setlistfm_url", "setlistfm_version")


@query
def touring_candidates(g):
    return ingest.touring_candidates(g.raw_events())


@query
def name_keys(g):
    titled = F.concat(F.lit("  "), F.col("text"), F.lit("\n("), F.col("source"), F.lit(") "))
    return g.table("documents").select(
        "doc_id",
        F.md5(text.cache_key(titled)).alias("cache_key_md5"),
        F.md5(text.strip_qualifier(titled)).alias("unqualified_md5"),
    )


@query
def name_normalised(g):
    normalised = g.table("documents").select("doc_id", text.normalise_name(F.col("text")).alias("n"))
    return normalised.select("doc_id", F.md5("n").alias("normalised_md5"), F.length("n").alias("letters"))


@query
def resolve_artists(g):
    searches = g.part_searches()
    names = searches.select(F.col("searched_name").alias("artist_name"))
    nothing_cached = typed_empty(g.spark, schemas.ARTIST_RESOLUTION)
    resolved = matching.resolve_artists(names, searches, nothing_cached)
    return resolved.select(
        "artist_name",
        "mbid",
        "formation_year",
        "artist_type",
        "primary_genre",
        F.array_join("genres", ",").alias("genres"),
        "mb_name",
    )


def _judged_artists(g):
    names = g.table("customer").select(F.col("c_name").alias("artist_name"))
    resolved = matching.resolve_artists(names, g.customer_searches(), g.cached_resolutions())
    return matching.verify_artists(resolved)


@query
def verified_events(g):
    events = matching.with_artist_id(g.raw_events(), matching.verified(_judged_artists(g)))
    return events.select("event_id", "artist_name", "artist_mbid")


@query
def artist_outcomes(g):
    return matching.count_by_reason(_judged_artists(g), "verified")


@query
def new_setlist_artists(g):
    artists = matching.artist_rows(_judged_artists(g), F.lit(LOADED_AT)).drop("extracted_at")
    return matching.without_setlists(artists, g.raw_setlists()).select("mbid", "artist_name", "primary_genre")


def _landed(g):
    """The documents as JSON files, read back as an ingest finds them."""
    folder = workspace.new_folder(g.spark, "landed")
    g.event_page_texts(0, 1).write.options(**LANDED).text(f"{folder}/events")
    for name, docs in (("setlists", g.setlist_pages()), ("searches", g.customer_searches())):
        docs.write.options(**LANDED).json(f"{folder}/{name}")
    return (
        landing.read_event_pages(g.spark, f"{folder}/events"),
        landing.read_setlist_pages(g.spark, f"{folder}/setlists"),
        landing.read_artist_searches(g.spark, f"{folder}/searches"),
    )


def _ingested(g):
    return ingest.ingest(
        *_landed(g),
        g.cached_resolutions(),
        mode="production",
        countries=[f"NATION_{i}" for i in range(25)],
        extracted_at=LOADED_AT,
        keep_scratch=True,
    )


@query
def dry_run_counts(g):
    return ingest.dry_run(_ingested(g).tables())


@query
def ingest_events(g):
    return _ingested(g).events.select("event_id", "event_name", "event_date", "artist_name", "artist_mbid", "venue_name", "country_code", "event_status")


@query
def ingest_setlists(g):
    return _ingested(g).setlists.select("setlist_id", "artist_name", "artist_mbid", "song_count", "songs_played")


@query
def ingest_artists(g):
    return _ingested(g).artists.select("mbid", "artist_name", "primary_genre", "artist_type")


@query
def cache_written_back(g):
    """The stored resolutions after an ingest: those of before, and what it found."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    store.overwrite("artist_resolution", g.cached_resolutions())
    ingest.write(store, _ingested(g))
    return store.read("artist_resolution").select("cache_key", "mbid")


@query
def exported_snapshots(g):
    """Touring rows, date range and yearly freshness as exported, read back: the rows of each set as text."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    dim = settled(_dim(g), "dim")
    fact = store.overwrite("fact_concert", core.fact_concert(_unified(g), dim, LOADED_AT))
    store.overwrite("mart_artist_touring_intensity", marts.touring_intensity(fact, dim, AS_OF))
    store.overwrite("mart_artist_setlist_freshness", marts.setlist_freshness(fact, dim))
    folder = workspace.new_folder(g.spark, "snapshots")
    export.export_snapshots(g.spark, store.read, folder, AS_OF)
    shown = {
        "touring_intensity": ("artist_name", "primary_genre", "country", "concert_count"),
        "date_range": ("min_date", "max_date"),
        "freshness": ("artist_name", "primary_genre", "concert_year", "concert_count", "unique_songs", "first_time_songs"),
        "meta": ("exported_date",),
    }
    parts = []
    for name, columns in shown.items():
        rows = g.spark.read.parquet(f"{folder}/{name}")
        day = {c: F.date_format(c, "yyyy-MM-dd") for c in columns if c.endswith("_date")}
        parts.append(rows.select(F.lit(name).alias("snapshot"), F.concat_ws("|", *[F.coalesce(day.get(c, F.col(c)).cast("string"), F.lit("-")) for c in columns]).alias("row")))
    return functools.reduce(DataFrame.unionByName, parts)


# --- checks -----------------------------------------------------------------------


@query
def future_rows(g):
    return quality.future_rows(g.raw_events(), AS_OF)


@query
def source_freshness(g):
    raw = {
        "ticketmaster_events": g.raw_events(),
        "setlistfm_setlists": g.raw_setlists(),
        "musicbrainz_artists": g.raw_artists(),
    }
    return readable(quality.freshness(raw, F.lit("2001-08-05").cast("timestamp")), "latest")


@query
def quality_report(g):
    """The checks on tables with faults: double events, dim-less artists, foreign sources."""
    raw = {
        "ticketmaster_events": g.raw_events(copies=True),
        "setlistfm_setlists": g.raw_setlists(mixed_dates=True),
        "musicbrainz_artists": g.raw_artists(namesakes=True),
    }
    events = staging.stg_events(raw["ticketmaster_events"], raw["musicbrainz_artists"])
    setlists = staging.stg_setlists(raw["setlistfm_setlists"])
    dim = core.dim_artist(raw["musicbrainz_artists"], raw["ticketmaster_events"], LOADED_AT)
    fact = core.fact_concert(staging.concerts_unified(events, setlists), dim, LOADED_AT)
    faulty = fact.withColumns(
        {
            "artist_id": F.when(F.col("country") == "NATION_3", F.lit("gone")).otherwise(F.col("artist_id")),
            "source": F.when(F.col("country") == "NATION_4", F.lit("radio")).otherwise(F.col("source")),
        }
    )
    return quality.core_report(raw, events, setlists, dim, faulty, dt.date(1998, 1, 1))


# --- stored tables ------------------------------------------------------------------


@query
def upsert_events(g):
    """A first load, then a second one that moves some events and brings a new column."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    first = g.raw_events().where("event_status IS NULL OR event_status = 'cancelled'")
    store.overwrite("ticketmaster_events", first)
    moved = (
        g.raw_events(copies=True)
        .where("event_status IS NULL OR event_status = 'onsale'")
        .withColumn("city", F.lit("moved"))
        .withColumn("currency", F.lit("GBP"))
        .drop("venue_id")
    )
    second = latest_per_key(moved, ["event_id"], ties=["venue_name"])
    result = store.upsert("ticketmaster_events", second)
    return result.select("event_id", "event_status", "venue_id", "venue_name", "city", "currency")


@query
def incremental_fact(g):
    """Two loads, the first without half the artists; the result equals one full build."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    events, setlists, artists = (settled(df, "raw") for df in (g.raw_events(), g.raw_setlists(), g.raw_artists()))
    early = F.col("extracted_at") < F.lit("1999-01-01").cast("timestamp")
    known = artists.where("mbid LIKE '%1' OR mbid LIKE '%4'")

    def load(artists, events, setlists, of_dim):
        dim = core.load_dim_artist(store, artists, of_dim, LOADED_AT)
        rows = core.due_concerts(store, events, setlists)
        unified = staging.concerts_unified(staging.stg_events(rows[0], g.raw_artists()), staging.stg_setlists(rows[1]))
        return core.load_fact_concert(store, unified, dim, LOADED_AT, taken=True)

    load(known, events.where(early), setlists.where(early), typed_empty(g.spark, schemas.RAW_EVENTS))
    return load(artists, events, setlists, events).drop("loaded_at")


@query
def full_refresh_fact(g):
    """A load of everything, then a full refresh with the later concerts: those alone are left."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    unified, dim = settled(_unified(g), "unified"), settled(_dim(g), "dim")
    core.load_fact_concert(store, unified, dim, LOADED_AT)
    late = F.col("extracted_at") >= F.lit("1999-01-01").cast("timestamp")
    return core.load_fact_concert(store, unified.where(late), dim, LOADED_AT, full_refresh=True).drop("loaded_at")


@query
def strict_fact(g):
    """A load of the concerts of some markets on one day, then a strict load of all: what was stamped before that day is lost."""
    store = TableStore(g.spark, workspace.new_folder(g.spark, "store"))
    unified, dim, day = settled(_unified(g), "unified"), settled(_dim(g), "dim"), dt.datetime(1999, 1, 1)
    core.load_fact_concert(store, unified.where("country < 'NATION_2'"), dim, day)
    return core.load_fact_concert(store, unified, dim, LOADED_AT, strict_reference=True).drop("loaded_at")
