"""Fixed table schemas, as Spark DDL strings. Nothing in the package infers a schema."""

# --- landed documents -------------------------------------------------------

EVENT = """
    id STRING, name STRING, url STRING,
    dates STRUCT<start: STRUCT<localDate: STRING, localTime: STRING, dateTime: STRING>,
                 status: STRUCT<code: STRING>>,
    _embedded STRUCT<
        attractions: ARRAY<STRUCT<
            name: STRING,
            upcomingEvents: STRUCT<_total: BIGINT>,
            classifications: ARRAY<STRUCT<type: STRUCT<name: STRING>,
                                          genre: STRUCT<name: STRING>,
                                          subGenre: STRUCT<name: STRING>>>>>,
        venues: ARRAY<STRUCT<id: STRING, name: STRING,
                             city: STRUCT<name: STRING>,
                             country: STRUCT<countryCode: STRING, name: STRING>>>>
"""

# country_order, chunk and page say in which order the pages arrived.
EVENT_PAGE = f"""
    country_order INT, chunk INT, page INT,
    _embedded STRUCT<events: ARRAY<STRUCT<{EVENT}>>>
"""

# `setlist`, `set` and `song` may hold one object or a list, so they are read as JSON text.
SETLIST_PAGE = "requested_artist STRING, requested_mbid STRING, setlist STRING"
SETLIST = """
    id STRING, versionId STRING, eventDate STRING, lastUpdated STRING, url STRING,
    artist STRUCT<mbid: STRING, name: STRING>,
    tour STRUCT<name: STRING>,
    venue STRUCT<name: STRING,
                 city: STRUCT<name: STRING, country: STRUCT<code: STRING, name: STRING>>>,
    sets STRUCT<`set`: STRING>
"""
SETLIST_SET = "song STRING"
SETLIST_SONG = "name STRING"

# Position in `artists` is the search rank.
ARTIST_SEARCH = """
    searched_name STRING,
    artists ARRAY<STRUCT<id: STRING, name: STRING, country: STRING, type: STRING,
                         disambiguation: STRING, `life-span`: STRUCT<begin: STRING>,
                         tags: ARRAY<STRUCT<name: STRING, count: BIGINT>>>>
"""

# --- tables -----------------------------------------------------------------

RAW_EVENTS = """
    event_id STRING, event_name STRING, event_date STRING, event_time STRING,
    event_datetime_utc TIMESTAMP, artist_name STRING, artist_mbid STRING, venue_id STRING,
    venue_name STRING, city STRING, country_code STRING, country_name STRING,
    event_status STRING, event_url STRING, tm_genre STRING, tm_subgenre STRING,
    extracted_at TIMESTAMP
"""
RAW_SETLISTS = """
    setlist_id STRING, event_date STRING, artist_name STRING, artist_mbid STRING,
    tour_name STRING, venue_name STRING, city STRING, country_code STRING,
    country_name STRING, song_count BIGINT, songs_played STRING, setlistfm_version STRING,
    setlistfm_last_updated TIMESTAMP, setlistfm_url STRING, extracted_at TIMESTAMP
"""
RAW_ARTISTS = """
    artist_name STRING, mbid STRING, origin_country STRING, formation_year BIGINT,
    artist_type STRING, primary_genre STRING, extracted_at TIMESTAMP
"""
# cache_version marks the shape of an entry; entries of an older shape are resolved again.
ARTIST_RESOLUTION = """
    cache_key STRING, artist_name STRING, mbid STRING, origin_country STRING,
    formation_year BIGINT, artist_type STRING, primary_genre STRING, genres ARRAY<STRING>,
    disambiguation STRING, mb_name STRING, cache_version INT
"""
STG_EVENTS = """
    concert_id STRING, artist_mbid STRING, artist_name STRING, venue_id STRING,
    venue_name STRING, city STRING, event_date DATE, country STRING, event_status STRING,
    extracted_at TIMESTAMP
"""
STG_SETLISTS = """
    setlist_id STRING, artist_mbid STRING, artist_name STRING, event_date DATE,
    country STRING, city STRING, venue_name STRING, songs_played_count BIGINT,
    songs_played STRING, tour_id STRING, extracted_at TIMESTAMP
"""
CONCERTS_UNIFIED = """
    concert_id STRING, artist_mbid STRING, artist_name STRING, event_date DATE,
    country STRING, city STRING, venue_name STRING, event_status STRING, setlist_id STRING,
    songs_played_count BIGINT, songs_played STRING, tour_id STRING, source STRING,
    extracted_at TIMESTAMP
"""
DIM_ARTIST = """
    artist_id STRING, mbid STRING, artist_name STRING, primary_genre STRING,
    _loaded_at TIMESTAMP
"""
# event_month is the physical partition column of the fact.
FACT_CONCERT = """
    concert_id STRING, artist_id STRING, artist_name STRING, event_date DATE,
    country STRING, city STRING, venue_name STRING, event_status STRING, setlist_id STRING,
    songs_played_count BIGINT, songs_played STRING, tour_id STRING, source STRING,
    loaded_at TIMESTAMP, event_month DATE
"""
TOURING_INTENSITY = """
    artist_name STRING, primary_genre STRING, country STRING, concert_count BIGINT
"""
YEARLY_REPERTOIRE = """
    artist_name STRING, primary_genre STRING, concert_year BIGINT, concert_count BIGINT,
    unique_songs BIGINT, total_song_performances BIGINT
"""
SETLIST_FRESHNESS = """
    artist_name STRING, primary_genre STRING, concert_year BIGINT, concert_count BIGINT,
    unique_songs BIGINT, first_time_songs BIGINT, repeated_songs BIGINT, freshness_pct DOUBLE
"""
ARTIST_SIMILARITY = """
    artist_a STRING, artist_b STRING, shared_venues BIGINT, jaccard_similarity DOUBLE,
    shared_venues_detail STRING
"""
LIVE_UPDATES = """
    event_id STRING, event_name STRING, artist_name STRING, event_date STRING,
    event_status STRING, venue_name STRING, city STRING, country_code STRING,
    observed_at TIMESTAMP, is_new BOOLEAN
"""
WATERMARK = "extracted_at TIMESTAMP"
SNAPSHOT_META = "exported_date DATE"
