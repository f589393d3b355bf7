"""The queries of `queries.py` as SQL for DuckDB over the given tables.

Written from the definitions, not from the Spark plans: joins fan out and are cut by
QUALIFY, counts are distinct counts over exploded rows, pairs come from a plain self join.
"""

from __future__ import annotations

# The oracles state their constants themselves, so that a wrong value in the code under test shows.
WHITE_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace()]

# Phrases that mark a listing as something other than a touring artist.
NON_ARTIST_PHRASES = (
    r"\btribut\w*\b",
    r"\bimpersonat\w*\b",
    r"\bcirque\b",
    r"\bon\s+ice\b",
    r"\bday\s+out\s+with\b",
    r"LIVE\s+[–—-]",
    r"\bhologram\b",
    r"\bthe\s+\w+\s+experience\b",
    r"\bopry\b",
    r"\bcelebrat\w*\b",
    r"\bmusical\b",
    r"\bbroadway\b",
    r"\bspectacular\b",
    r"\bresidency\b",
    r"\blegacy\b",
    r"\b(?:sounds?|songs?|music|echoes?|rumours?)\s+of\b",
    r"\b(?:salute|homage)\s+to\b",
)

_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
_BLANK_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE) + "]"


def _strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _name_key(x: str) -> str:
    return f"lower({_strip(x)})"


_MBID = "'C' || c_custkey"
_VENUE = "o_orderpriority || ' hall, ' || n_name"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'onsale' END"
_TYPE = """CASE c_nationkey % 5 WHEN 0 THEN 'Group' WHEN 2 THEN 'Person'
           WHEN 3 THEN 'Character' WHEN 4 THEN 'Orchestra' END"""
_PERFORMER = "coalesce(artist_type, 'Person') IN ('Person', 'Group', 'Orchestra', 'Choir')"
_OFF = "('cancelled', 'postponed')"

# Named pieces; a piece may use those above it.
PIECES = {
    "customers": "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "concerts": "SELECT * FROM orders JOIN customers ON o_custkey = c_custkey",
    "raw_events": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS event_id, o_orderpriority AS event_name,
               strftime(o_orderdate, '%Y-%m-%d') AS event_date,
               CASE o_orderkey % 3 WHEN 0 THEN '  ' || upper(c_name)
                    WHEN 1 THEN lower(c_name) || chr(160) ELSE c_name END AS artist_name,
               CASE WHEN c_nationkey % 5 = 3 OR o_orderkey % 2 = 0 THEN {_MBID} END AS artist_mbid,
               'V' || c_nationkey || '-' || o_orderpriority[1] AS venue_id,
               {_VENUE} AS venue_name, n_name AS city, n_name AS country_code,
               {_STATUS} AS event_status, o_orderdate AS extracted_at
        FROM concerts""",
    "copied_events": """
        SELECT * FROM raw_events
        UNION ALL BY NAME
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS artist_mbid, 'elsewhere' AS venue_name,
                          extracted_at - INTERVAL 1 DAY AS extracted_at)
        FROM raw_events""",
    "raw_artists": f"""
        SELECT upper(c_name) AS artist_name, {_MBID} AS mbid, {_TYPE} AS artist_type,
               'unsorted' AS primary_genre, TIMESTAMP '2000-09-01' AS extracted_at
        FROM customers
        UNION ALL
        SELECT c_name, {_MBID}, {_TYPE}, lower(c_mktsegment), TIMESTAMP '2001-09-01' FROM customers""",
    "twin_artists": """
        SELECT * FROM raw_artists
        UNION ALL
        SELECT c_name, 'X' || c_custkey, 'Group', 'hip-hop', TIMESTAMP '2001-10-01'
        FROM customers WHERE c_mktsegment = 'BUILDING'""",
    "song_lists": """
        SELECT l_orderkey, count(*) AS song_count,
               string_agg(p_name, '; ' ORDER BY l_linenumber, p_name) AS songs_played
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "setlist_base": f"""
        SELECT 'S' || o_orderkey AS setlist_id, c_name AS artist_name, {_MBID} AS artist_mbid,
               o_orderpriority AS tour_name, {_VENUE} AS venue_name, n_name AS city,
               n_name AS country_code, coalesce(song_count, 0) AS song_count, songs_played,
               o_orderdate, o_orderkey, o_orderstatus, c_mktsegment
        FROM concerts LEFT JOIN song_lists ON o_orderkey = l_orderkey""",
    "raw_setlists": """
        SELECT *, CAST(o_orderdate + INTERVAL 120 MONTH AS DATE) AS day FROM setlist_base""",
    "mixed_setlists": """
        SELECT *, CASE WHEN o_orderkey % 4 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
        FROM setlist_base""",
}


def _stg_events(events: str, artists: str) -> str:
    return f"""
        SELECT e.event_id AS concert_id, coalesce(e.artist_mbid, m.mbid) AS artist_mbid,
               e.artist_name, e.venue_id, e.venue_name, e.city,
               CAST(e.event_date AS DATE) AS event_date, e.country_code AS country,
               e.event_status, e.extracted_at
        FROM {events} e
        LEFT JOIN {artists} m ON {_name_key('e.artist_name')} = {_name_key('m.artist_name')}
        WHERE e.event_status IS NULL OR e.event_status NOT IN {_OFF}
        QUALIFY row_number() OVER (
            PARTITION BY e.event_id
            ORDER BY e.artist_mbid IS NULL, m.extracted_at DESC NULLS LAST, m.mbid NULLS LAST,
                     e.extracted_at DESC) = 1"""


def _stg_setlists(setlists: str) -> str:
    return f"""
        SELECT setlist_id, artist_mbid, artist_name, day AS event_date, country_code AS country,
               city, venue_name, song_count AS songs_played_count, songs_played,
               tour_name AS tour_id, o_orderdate AS extracted_at
        FROM {setlists} WHERE day >= DATE '2000-01-01'"""


def _dim(events: str, artists: str) -> str:
    return f"""
        WITH best AS (
            SELECT mbid, artist_name, primary_genre FROM {artists}
            WHERE mbid IS NOT NULL AND {_PERFORMER}
            QUALIFY row_number() OVER (PARTITION BY mbid ORDER BY extracted_at DESC) = 1),
        seen AS (
            SELECT artist_mbid AS mbid, artist_name FROM {events} WHERE artist_mbid IS NOT NULL
            QUALIFY row_number() OVER (
                PARTITION BY artist_mbid ORDER BY extracted_at DESC, event_id) = 1)
        SELECT mbid AS artist_id, * FROM best
        UNION ALL BY NAME
        SELECT mbid AS artist_id, mbid, artist_name, NULL AS primary_genre
        FROM seen WHERE mbid NOT IN (SELECT mbid FROM best)"""


def _unified(events: str, setlists: str) -> str:
    return f"""
        SELECT concert_id, artist_mbid, artist_name, event_date, country, city, venue_name,
               event_status, CAST(NULL AS VARCHAR) AS setlist_id,
               CAST(NULL AS BIGINT) AS songs_played_count, CAST(NULL AS VARCHAR) AS songs_played,
               CAST(NULL AS VARCHAR) AS tour_id, 'ticketmaster' AS source, extracted_at
        FROM {events}
        UNION ALL
        SELECT setlist_id, artist_mbid, artist_name, event_date, country, city, venue_name,
               NULL, setlist_id, songs_played_count, songs_played, tour_id, 'setlistfm', extracted_at
        FROM {setlists}"""


def _fact(unified: str, dim: str) -> str:
    return f"""
        SELECT u.concert_id, d.artist_id, coalesce(d.artist_name, u.artist_name) AS artist_name,
               u.event_date, u.country, u.city, u.venue_name, u.event_status, u.setlist_id,
               u.songs_played_count, u.songs_played, u.tour_id, u.source,
               CAST(date_trunc('month', u.event_date) AS DATE) AS event_month
        FROM {unified} u LEFT JOIN {dim} d ON u.artist_mbid = d.mbid"""


PIECES |= {
    "stg_events": _stg_events("raw_events", "raw_artists"),
    "stg_setlists": _stg_setlists("raw_setlists"),
    "unified": _unified("stg_events", "stg_setlists"),
    "dim": _dim("raw_events", "raw_artists"),
    "fact": _fact("unified", "dim"),
    # Genres of the given data are single words.
    "linked": """
        SELECT f.*, coalesce(d.artist_name, f.artist_name) AS artist,
               upper(d.primary_genre[1]) || lower(d.primary_genre[2:]) AS primary_genre,
               CAST(year(f.event_date) AS BIGINT) AS concert_year
        FROM fact f LEFT JOIN dim d ON f.artist_id = d.artist_id""",
    "touring": """
        SELECT artist AS artist_name, primary_genre, country, count(*) AS concert_count
        FROM linked
        WHERE source = 'ticketmaster' AND event_date >= DATE '2000-01-01'
          AND artist_id IS NOT NULL AND artist_name IS NOT NULL
        GROUP BY ALL""",
    "sung": f"""
        SELECT artist, primary_genre, concert_year, concert_id, {_strip('song')} AS song
        FROM (SELECT *, unnest(string_split(songs_played, '; ')) AS song FROM linked
              WHERE source = 'setlistfm' AND event_date IS NOT NULL)
        WHERE {_strip('song')} <> ''""",
    "repertoire": """
        SELECT s.artist AS artist_name, s.primary_genre, s.concert_year, c.n AS concert_count,
               count(DISTINCT s.song) AS unique_songs, count(*) AS total_song_performances
        FROM sung s
        JOIN (SELECT artist, primary_genre, concert_year, count(DISTINCT concert_id) AS n
              FROM linked WHERE source = 'setlistfm' AND event_date IS NOT NULL GROUP BY ALL) c
          ON s.artist = c.artist AND s.concert_year = c.concert_year
        GROUP BY ALL""",
    "freshness": """
        SELECT w.artist AS artist_name, w.primary_genre, w.concert_year, c.n AS concert_count,
               w.songs AS unique_songs, w.fresh AS first_time_songs,
               w.songs - w.fresh AS repeated_songs,
               round(w.fresh / w.songs * 100, 1) AS freshness_pct
        FROM (SELECT s.artist, s.primary_genre, s.concert_year, count(DISTINCT s.song) AS songs,
                     count(DISTINCT s.song) FILTER (f.debut = s.concert_year) AS fresh
              FROM sung s
              JOIN (SELECT artist, song, min(concert_year) AS debut FROM sung GROUP BY ALL) f
                ON s.artist = f.artist AND s.song = f.song
              GROUP BY ALL) w
        JOIN (SELECT artist, concert_year, count(DISTINCT concert_id) AS n
              FROM linked WHERE source = 'setlistfm' AND event_date IS NOT NULL GROUP BY ALL) c
          ON w.artist = c.artist AND w.concert_year = c.concert_year""",
    "visits": """
        SELECT DISTINCT s_name AS artist, 'Venue ' || l_partkey AS venue
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "edges": """
        WITH sizes AS (SELECT artist, count(*) AS n FROM visits GROUP BY artist),
        shared AS (
            SELECT a.artist AS artist_a, b.artist AS artist_b, count(*) AS n,
                   string_agg(a.venue, '; ' ORDER BY a.venue) AS detail
            FROM visits a JOIN visits b ON a.venue = b.venue AND a.artist < b.artist
            GROUP BY ALL)
        SELECT artist_a, artist_b, s.n AS shared_venues,
               round(s.n / (x.n + y.n - s.n), 4) AS jaccard_similarity,
               detail AS shared_venues_detail
        FROM shared s JOIN sizes x ON x.artist = artist_a JOIN sizes y ON y.artist = artist_b""",
    "live": """
        SELECT CAST(user_id AS VARCHAR) AS event_id, event_type AS event_status, ts AS observed_at,
               'Artist ' || user_id AS artist_name,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) = 1 AS is_new
        FROM events""",
    # Landed pages: the listing of each order and a late one in another market.
    "listings": f"""
        SELECT o_orderkey, 0 AS place, o_orderpriority AS event_name, c_name AS artist_name,
               o_orderkey % 8 AS total, o_orderpriority <> '5-LOW' AS billed,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Venue Based' ELSE 'Person' END AS kind,
               CASE WHEN o_orderpriority = '1-URGENT' THEN c_name || ' Arena' ELSE {_VENUE} END AS venue_name,
               coalesce({_STATUS}, '') AS event_status, c_mktsegment, n_name, o_orderdate
        FROM concerts
        UNION ALL
        SELECT o_orderkey, 1, 'late listing', 'Late ' || c_name, 5, true, 'Person', {_VENUE},
               coalesce({_STATUS}, ''), c_mktsegment, n_name, o_orderdate
        FROM concerts""",
    "judged": """
        SELECT *, CASE
            WHEN NOT billed THEN 'no_attraction'
            WHEN total < 3 THEN 'few_upcoming'
            WHEN kind IN ('Event Style', 'Venue Based') THEN 'not_an_artist'
            WHEN event_status IN ('cancelled', 'postponed') THEN 'called_off'
            WHEN contains(regexp_replace(lower(venue_name), '[^a-z0-9 ]', '', 'g'),
                          regexp_replace(lower(artist_name), '[^a-z0-9 ]', '', 'g'))
              THEN 'venue_as_artist' END AS reason
        FROM listings""",
    "kept_events": """
        SELECT * FROM judged WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY place) = 1""",
    # Customers searched by name: cached, found, or not found.
    "resolved": f"""
        SELECT c_name, CASE c_nationkey % 5 WHEN 1 THEN NULL WHEN 2 THEN 'K' || c_custkey
                       ELSE {_MBID} END AS mbid,
               CASE c_nationkey % 5 WHEN 1 THEN NULL WHEN 2 THEN 'Person' ELSE {_TYPE} END AS artist_type,
               CASE WHEN c_nationkey % 5 NOT IN (1, 2) AND c_mktsegment = 'BUILDING'
                    THEN 'Tribute band' END AS disambiguation,
               CASE c_nationkey % 5 WHEN 2 THEN 'cached' ELSE lower(c_mktsegment) END AS primary_genre
        FROM customer""",
    "artists_judged": f"""
        SELECT *, CASE WHEN mbid IS NULL THEN 'no_mbid'
                       WHEN NOT ({_PERFORMER}) THEN 'artist_type'
                       WHEN lower(disambiguation) LIKE '%tribute%' THEN 'tribute' END AS reason
        FROM resolved""",
}


def with_pieces(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the pieces a query uses, directly or through others, in order."""
    pieces = PIECES | (extra or {})
    needed, text = [], query
    for name in reversed(pieces):
        if _mentions(text, name):
            needed.insert(0, name)
            text += pieces[name]
    ctes = ",\n".join(f"{n} AS ({pieces[n]})" for n in needed)
    return f"WITH {ctes}\n{query}" if needed else query


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) is not None


ORACLES: dict[str, str] = {}


def oracle(name: str, query: str, **extra: str) -> None:
    ORACLES[name] = with_pieces(query, extra)


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


# --- staging and core ---------------------------------------------------------------

oracle(
    "stg_events",
    f"SELECT * REPLACE ({_stamp('extracted_at')} AS extracted_at) FROM staged",
    staged=_stg_events("copied_events", "twin_artists"),
)
oracle(
    "stg_setlists",
    f"SELECT * REPLACE ({_stamp('extracted_at')} AS extracted_at) FROM staged",
    staged=_stg_setlists("mixed_setlists"),
)
oracle("concerts_unified", f"SELECT * REPLACE ({_stamp('extracted_at')} AS extracted_at) FROM unified")
oracle("dim_artist", "SELECT * FROM artists", artists=_dim("raw_events", "twin_artists"))
oracle("fact_concert", "SELECT * FROM fact")
oracle("incremental_fact", "SELECT * FROM fact")
oracle(
    "full_refresh_fact",
    "SELECT f.* FROM fact f JOIN unified u USING (concert_id) WHERE u.extracted_at >= TIMESTAMP '1999-01-01'",
)
oracle(
    "strict_fact",
    """SELECT f.* FROM fact f JOIN unified u USING (concert_id)
       WHERE u.country < 'NATION_2' OR u.extracted_at > TIMESTAMP '1999-01-01'""",
)
oracle(
    "checkpoint_view",
    f"""
    SELECT e.event_id AS concert_id, m.mbid AS artist_mbid, e.venue_id,
           CAST(e.event_date AS DATE) AS event_date, e.country_code AS country,
           CAST(NULL AS DOUBLE) AS ticket_price_min_gbp,
           CAST(NULL AS DOUBLE) AS ticket_price_max_gbp, e.event_status
    FROM copied_events e
    LEFT JOIN twin_artists m ON {_name_key('e.artist_name')} = {_name_key('m.artist_name')}
    QUALIFY row_number() OVER (
        PARTITION BY e.event_id
        ORDER BY m.extracted_at DESC NULLS LAST, m.mbid NULLS LAST, e.extracted_at DESC) = 1""",
)

# --- marts and boards ---------------------------------------------------------------

oracle("touring_intensity", "SELECT * FROM touring")
oracle("yearly_repertoire", "SELECT * FROM repertoire")
oracle("setlist_freshness", "SELECT * FROM freshness")
oracle("venue_similarity", "SELECT * FROM edges")
oracle(
    "top_touring_rows",
    """SELECT * FROM touring
       ORDER BY concert_count DESC, artist_name, primary_genre NULLS FIRST, country LIMIT 500""",
)
_TOP = """SELECT artist_name, CAST(sum(concert_count) AS BIGINT) AS concert_count
          FROM touring GROUP BY artist_name ORDER BY concert_count DESC, artist_name LIMIT 15"""
oracle("top_artists", _TOP)
oracle(
    "top_artists_by_country",
    f"""SELECT artist_name, country, CAST(sum(concert_count) AS BIGINT) AS concert_count
        FROM touring WHERE artist_name IN (SELECT artist_name FROM ({_TOP})) GROUP BY ALL""",
)
oracle(
    "top_genres",
    """SELECT primary_genre, CAST(sum(concert_count) AS BIGINT) AS concert_count FROM touring
       WHERE primary_genre IS NOT NULL GROUP BY primary_genre
       ORDER BY concert_count DESC, primary_genre LIMIT 10""",
)
oracle(
    "upcoming_date_range",
    """SELECT min(event_date) AS min_date, max(event_date) AS max_date FROM fact
       WHERE source = 'ticketmaster' AND event_date >= DATE '2000-01-01'""",
)
oracle(
    "evolution_snapshot",
    """SELECT * FROM freshness WHERE artist_name IS NOT NULL
       ORDER BY artist_name, concert_year, primary_genre NULLS FIRST, concert_count,
                unique_songs, first_time_songs""",
)
oracle(
    "artist_evolution",
    """SELECT r.*, f.first_time_songs, f.repeated_songs, f.freshness_pct
       FROM (SELECT * FROM repertoire WHERE concert_count >= 2) r
       LEFT JOIN (SELECT * FROM freshness WHERE concert_count >= 2
                  QUALIFY concert_year > min(concert_year) OVER (PARTITION BY artist_name)) f
         ON r.artist_name = f.artist_name AND r.concert_year = f.concert_year
        AND r.primary_genre IS NOT DISTINCT FROM f.primary_genre""",
)
oracle(
    "artist_totals",
    """SELECT artist_name, min(primary_genre) AS primary_genre, count(*) AS total_years,
              CAST(sum(unique_songs) AS BIGINT) AS total_unique,
              CAST(sum(total_song_performances) AS BIGINT) AS total_performances
       FROM repertoire WHERE concert_count >= 2 GROUP BY artist_name""",
)
oracle(
    "all_artists",
    "SELECT artist_name FROM repertoire UNION SELECT artist_name FROM freshness",
)
_EDGE = "artist_a, artist_b, shared_venues, jaccard_similarity"
oracle(
    "similarity_top_pairs",
    f"SELECT {_EDGE} FROM edges ORDER BY jaccard_similarity DESC, artist_a, artist_b LIMIT 5000",
)
oracle(
    "similarity_of_named_venues",
    "SELECT artist_a, artist_b, shared_venues, jaccard_similarity FROM edges",
    visits="""SELECT DISTINCT s_name AS artist, 'Venue ' || l_partkey AS venue
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey % 7 > 1""",
)
oracle(
    "similar_to_artist",
    """SELECT CASE WHEN artist_a = 'Supplier#000000001' THEN artist_b ELSE artist_a END AS similar_artist, shared_venues, jaccard_similarity
       FROM edges WHERE 'Supplier#000000001' IN (artist_a, artist_b)
       ORDER BY jaccard_similarity DESC, similar_artist LIMIT 10""",
)
oracle(
    "similar_artists_top10",
    """SELECT *, CAST(row_number() OVER (PARTITION BY artist_name
                      ORDER BY jaccard_similarity DESC, similar_artist) AS INTEGER) AS similarity_rank
       FROM (SELECT artist_a AS artist_name, artist_b AS similar_artist, shared_venues,
                    jaccard_similarity FROM edges
             UNION ALL
             SELECT artist_b, artist_a, shared_venues, jaccard_similarity FROM edges)
       QUALIFY similarity_rank <= 10""",
)

# --- live log -----------------------------------------------------------------------

oracle(
    "live_metrics",
    f"""SELECT count(DISTINCT event_id) AS events_tracked,
               count(DISTINCT event_id) FILTER (is_new) AS new_listings,
               {_stamp('max(observed_at)')} AS latest_update FROM live""",
)
oracle(
    "live_status_breakdown",
    """SELECT event_status, count(DISTINCT event_id) AS event_count FROM live
       GROUP BY event_status""",
)
oracle(
    "live_recent",
    """SELECT artist_name AS "Artist", event_status AS "Event", event_status AS "Status",
              'Town' AS "City", 'GB' AS "Country", strftime(observed_at, '%H:%M %d/%m') AS "Observed"
       FROM live ORDER BY observed_at DESC, event_id, event_status LIMIT 20""",
)
oracle("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
oracle(
    "stream_first_seen",
    f"SELECT event_id, event_status, {_stamp('observed_at')} AS observed_at, is_new FROM live",
)

oracle(
    "live_payload_stream",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS event_id, event_name, artist_name || CASE WHEN place = 0 THEN ' (US Tour)' ELSE '' END AS artist_name,
               strftime(o_orderdate, '%Y-%m-%d') AS event_date, CASE WHEN event_status = '' THEN 'unknown' ELSE event_status END AS event_status, venue_name, n_name AS city,
               n_name AS country_code, {_stamp("TIMESTAMP '2012-01-01'")} AS observed_at,
               row_number() OVER (PARTITION BY o_orderkey ORDER BY place) = 1 AS is_new
        FROM listings WHERE billed AND total >= 3 AND kind NOT IN ('Event Style', 'Venue Based') AND event_status NOT IN {_OFF}""",
)
oracle(
    "stream_table_grows",
    f"""SELECT CAST(user_id AS VARCHAR) AS event_id, event_type AS event_status, {_stamp('CAST(ts AS TIMESTAMP)')} AS observed_at,
               CASE WHEN event_type < 'm' THEN NULL ELSE 'Town' END AS city FROM events""",
)

# --- landed documents and entity resolution -------------------------------------------

_MARKETS = ", ".join(f"'NATION_{i}'" for i in range(20))
oracle(
    "flatten_events",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS event_id, event_name,
           strftime(o_orderdate, '%Y-%m-%d') AS event_date, artist_name, venue_name,
           n_name AS city, n_name AS country_code, event_status,
           {_stamp('o_orderdate')} AS event_datetime_utc, c_mktsegment AS tm_genre,
           CAST(NULL AS VARCHAR) AS tm_subgenre
    FROM (SELECT * FROM judged
          WHERE reason IS NULL AND n_name IN ({_MARKETS})
            AND o_orderdate BETWEEN DATE '2000-01-01' AND DATE '2000-01-01' + 365
          QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY place) = 1)""",
)
oracle("event_outcomes", "SELECT coalesce(reason, 'kept') AS outcome, count(*) AS n FROM judged GROUP BY ALL")
oracle(
    "outcomes_without_ids",
    """SELECT CASE WHEN o_orderkey % 5 < 2 AND coalesce(reason, '') NOT IN ('no_attraction', 'few_upcoming', 'not_an_artist', 'called_off') THEN 'no_id'
                   ELSE coalesce(reason, 'kept') END AS outcome, count(*) AS n FROM judged GROUP BY ALL""",
)
_RECENT = "(o_orderstatus = 'P' OR o_orderdate >= DATE '2000-01-01')"
oracle(
    "flatten_setlists",
    f"""
    SELECT setlist_id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%d-%m-%Y') END
               AS event_date,
           artist_name, artist_mbid, tour_name, venue_name, city, country_code,
           CAST(NULL AS VARCHAR) AS country_name, song_count, songs_played
    FROM setlist_base WHERE {_RECENT}""",
)
_SHOW = "regexp_matches(artist_name, '(?i)" + "|".join(NON_ARTIST_PHRASES) + "')"
oracle(
    "show_names",
    f"""SELECT c_custkey, artist_name, {_SHOW} AS is_show
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'The Sound of ' ELSE '' END || c_name ||
                     [' on Ice', ': The Musical', ' LIVE – one night', ' and Friends', ' (a Tribute)', ' Legacy Band', ''][1 + c_custkey % 7] AS artist_name
              FROM customer)""",
)
oracle(
    "touring_candidates",
    f"""SELECT {_strip('artist_name')} AS artist_name, count(*) AS event_count
        FROM raw_events WHERE NOT {_SHOW} GROUP BY 1
        ORDER BY event_count DESC, artist_name LIMIT 120""",
)
_TITLED = "'  ' || text || chr(10) || '(' || source || ') '"
oracle(
    "name_keys",
    f"""SELECT doc_id, md5({_name_key(f'({_TITLED})')}) AS cache_key_md5,
               md5({_strip(f"regexp_replace({_TITLED}, '{_BLANK_CLASS}*\\([^)]*\\){_BLANK_CLASS}*$', '')")})
                   AS unqualified_md5
        FROM documents""",
)
oracle(
    "name_normalised",
    f"""
    SELECT doc_id, md5(n) AS normalised_md5, CAST(length(n) AS INTEGER) AS letters
    FROM (SELECT doc_id, {_strip(f'''regexp_replace(regexp_replace(regexp_replace(regexp_replace(
              lower(strip_accents({_strip('text')})), '^the{_BLANK_CLASS}+', ''),
              '{_BLANK_CLASS}*&{_BLANK_CLASS}*', ' and ', 'g'),
              '[^a-z0-9{_BLANK_CLASS[1:-1]}]', '', 'g'), '{_BLANK_CLASS}+', ' ', 'g')''')} AS n
          FROM documents)""",
)
oracle(
    "resolve_artists",
    """
    WITH results AS (
        SELECT p_partkey, p_size, p_type, p_name || ' ' || p_partkey AS full_name,
               unnest([
                   {r: 0, id: 'a' || p_partkey, name: 'Big ' || p_name || ' ' || p_partkey, tags: p_size},
                   {r: 1, id: 'b' || p_partkey, name: p_name || ' ' || p_partkey || ' Band', tags: p_size % 7},
                   {r: 2, id: 'c' || p_partkey, name: CASE WHEN p_size % 3 = 0
                        THEN 'The ' || upper(p_name || ' ' || p_partkey) ELSE p_type END, tags: p_size % 12},
                   {r: 3, id: 'd' || p_partkey, name: p_name, tags: p_size % 20},
                   {r: 4, id: 'e' || p_partkey, name: p_type, tags: 0},
                   {r: 5, id: 'f' || p_partkey, name: CASE WHEN p_size % 5 = 0
                        THEN p_name || ' ' || p_partkey ELSE p_type END, tags: p_size % 12},
                   {r: 6, id: 'g' || p_partkey, name: CASE WHEN p_size % 7 = 0
                        THEN CAST(p_partkey AS VARCHAR) || '00' ELSE p_name END, tags: 40}], recursive := true)
        FROM part),
    keyed AS (SELECT *, regexp_replace(lower(name), '^the ', '') AS key, lower(full_name) AS wanted
              FROM results),
    best AS (SELECT * FROM keyed WHERE starts_with(key, wanted)
             QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY key <> wanted, r) = 1),
    trusted AS (SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM keyed o WHERE o.p_partkey = b.p_partkey AND o.r <> b.r AND length(o.key) >= 4
           AND contains(b.key, o.key) AND o.tags >= 10 AND o.tags >= b.tags + 3)),
    tagged AS (SELECT p_partkey, i, (i * 7) % 5 AS votes
               FROM (SELECT p_partkey, unnest(range(1, tags + 1)) AS i FROM trusted)),
    genres AS (SELECT p_partkey, string_agg('tag' || i, ',' ORDER BY votes DESC, i) AS genres,
                      first('tag' || i ORDER BY votes DESC, i) AS top
               FROM tagged GROUP BY p_partkey)
    SELECT p_name || ' ' || p.p_partkey || CASE WHEN p.p_size % 2 = 0 THEN ' (US Tour)' ELSE '' END
               AS artist_name,
           t.id AS mbid,
           CASE WHEN t.id IS NOT NULL AND p.p_size % 4 = 0 THEN CAST(1950 + p.p_size AS BIGINT) END
               AS formation_year,
           t.p_type AS artist_type, g.top AS primary_genre,
           coalesce(g.genres, '') AS genres, t.name AS mb_name
    FROM part p LEFT JOIN trusted t ON p.p_partkey = t.p_partkey
    LEFT JOIN genres g ON p.p_partkey = g.p_partkey""",
)
oracle(
    "verified_events",
    f"""SELECT event_id, artist_name, a.mbid AS artist_mbid
        FROM raw_events JOIN artists_judged a
          ON {_name_key('artist_name')} = lower(a.c_name) AND a.reason IS NULL""",
)
oracle(
    "artist_outcomes",
    "SELECT coalesce(reason, 'verified') AS outcome, count(*) AS n FROM artists_judged GROUP BY ALL",
)
oracle(
    "new_setlist_artists",
    """SELECT mbid, c_name AS artist_name, primary_genre FROM resolved
       WHERE mbid IS NOT NULL
         AND mbid NOT IN (SELECT artist_mbid FROM setlist_base)""",
)
_FOUND = "SELECT * FROM artists_judged WHERE c_name IN (SELECT artist_name FROM kept_events)"
oracle(
    "dry_run_counts",
    f"""
    SELECT 'ticketmaster_events' AS table_name, count(*) AS n FROM kept_events
     WHERE artist_name IN (SELECT c_name FROM found WHERE reason IS NULL)
    UNION ALL
    SELECT 'setlistfm_setlists', count(*) FROM setlist_base
     WHERE {_RECENT} AND artist_mbid IN (SELECT mbid FROM found WHERE reason IS NULL)
    UNION ALL
    SELECT 'musicbrainz_artists', count(*) FROM found WHERE mbid IS NOT NULL""",
    found=_FOUND,
)
oracle(
    "ingest_events",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS event_id, event_name, strftime(o_orderdate, '%Y-%m-%d') AS event_date, artist_name,
           f.mbid AS artist_mbid, venue_name, n_name AS country_code, event_status
    FROM kept_events JOIN found f ON artist_name = f.c_name AND f.reason IS NULL""",
    found=_FOUND,
)
oracle(
    "ingest_setlists",
    f"""
    SELECT setlist_id, artist_name, artist_mbid, song_count, songs_played FROM setlist_base
    WHERE {_RECENT} AND artist_mbid IN (SELECT mbid FROM found WHERE reason IS NULL)""",
    found=_FOUND,
)
oracle("ingest_artists", "SELECT mbid, c_name AS artist_name, primary_genre, artist_type FROM found WHERE mbid IS NOT NULL", found=_FOUND)
oracle(
    "cache_written_back",
    """
    SELECT lower(c_name) AS cache_key, CASE WHEN c_name IN (SELECT c_name FROM found) THEN mbid ELSE 'K' || c_custkey END AS mbid
    FROM (SELECT r.c_name, r.mbid, c_custkey, c_nationkey % 5 AS fifth FROM resolved r JOIN customer c ON r.c_name = c.c_name)
    WHERE fifth IN (2, 4) OR c_name IN (SELECT c_name FROM found)""",
    found=_FOUND,
)
oracle(
    "exported_snapshots",
    """
    SELECT 'touring_intensity' AS snapshot, concat_ws('|', coalesce(artist_name, '-'), coalesce(primary_genre, '-'), coalesce(country, '-'), concert_count) AS row FROM touring
    UNION ALL
    SELECT 'date_range', concat_ws('|', coalesce(CAST(min(event_date) AS VARCHAR), '-'), coalesce(CAST(max(event_date) AS VARCHAR), '-')) FROM fact
    WHERE source = 'ticketmaster' AND event_date >= DATE '2000-01-01'
    UNION ALL
    SELECT 'freshness', concat_ws('|', artist_name, coalesce(primary_genre, '-'), concert_year, concert_count, unique_songs, first_time_songs)
    FROM freshness WHERE artist_name IS NOT NULL
    UNION ALL
    SELECT 'meta', '2000-01-01'""",
)

# --- checks -------------------------------------------------------------------------

oracle("future_rows", "SELECT count(*) AS invalid_rows FROM raw_events WHERE event_date > '2000-01-01'")
_LATEST = {
    "ticketmaster_events": "SELECT max(extracted_at) FROM raw_events",
    "setlistfm_setlists": "SELECT max(o_orderdate) FROM setlist_base",
    "musicbrainz_artists": "SELECT max(extracted_at) FROM raw_artists",
}
oracle(
    "source_freshness",
    f"""SELECT source_table, {_stamp('latest')} AS latest,
               CASE WHEN latest < TIMESTAMP '2001-08-05' - INTERVAL 7 DAY THEN 'error'
                    WHEN latest < TIMESTAMP '2001-08-05' - INTERVAL 3 DAY THEN 'warn'
                    ELSE 'pass' END AS status
        FROM ("""
    + " UNION ALL ".join(f"SELECT '{t}' AS source_table, ({q}) AS latest" for t, q in _LATEST.items())
    + ")",
)


def _quality() -> str:
    counts = {}

    def not_null(check, table, *columns):
        for c in columns:
            counts[f"{check}.{c}.not_null"] = f"SELECT count(*) FROM {table} WHERE {c} IS NULL"

    def unique(check, table, *columns):
        for c in columns:
            counts[f"{check}.{c}.unique"] = (
                f"SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL"
                f" GROUP BY {c} HAVING count(*) > 1)"
            )

    not_null("raw_events", "copied_events", "event_id")
    unique("raw_events", "copied_events", "event_id")
    not_null("raw_setlists", "mixed_setlists", "setlist_id")
    unique("raw_setlists", "mixed_setlists", "setlist_id")
    not_null("raw_artists", "twin_artists", "mbid")
    not_null("stg_events", "q_events", "concert_id", "event_date", "country")
    unique("stg_events", "q_events", "concert_id")
    not_null("stg_setlists", "q_setlists", "setlist_id", "event_date", "artist_name")
    unique("stg_setlists", "q_setlists", "setlist_id")
    not_null("dim_artist", "q_dim", "artist_id", "mbid", "artist_name")
    unique("dim_artist", "q_dim", "artist_id", "mbid")
    not_null("fact_concert", "q_fact", "concert_id", "event_date")
    unique("fact_concert", "q_fact", "concert_id")
    counts["fact_concert.source.accepted_values"] = (
        "SELECT count(*) FROM q_fact WHERE country = 'NATION_4'"
    )
    counts["fact_concert.artist_id.relationship"] = (
        "SELECT count(*) FROM q_fact WHERE country = 'NATION_3'"
        " OR artist_id NOT IN (SELECT artist_id FROM q_dim)"
    )
    counts["fact_concert.event_date.too_far_ahead"] = (
        "SELECT count(*) FROM q_fact WHERE event_date > DATE '2001-01-01'"
    )
    counts["dim_artist.artist_type.invalid"] = (
        "SELECT count(*) FROM q_dim d JOIN twin_artists a ON d.mbid = a.mbid"
        f" WHERE a.artist_type IS NOT NULL AND NOT ({_PERFORMER})"
    )
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({q}) AS violations" for n, q in counts.items())


oracle(
    "quality_report",
    _quality(),
    q_events=_stg_events("copied_events", "twin_artists"),
    q_setlists=_stg_setlists("mixed_setlists"),
    q_unified=_unified("q_events", "q_setlists"),
    q_dim=_dim("copied_events", "twin_artists"),
    q_fact=_fact("q_unified", "q_dim"),
)

# --- stored tables ------------------------------------------------------------------

oracle(
    "upsert_events",
    """
    SELECT event_id, event_status, CASE WHEN event_status = 'cancelled' THEN venue_id END AS venue_id,
           venue_name, CASE WHEN event_status = 'cancelled' THEN city ELSE 'moved' END AS city,
           CASE WHEN event_status = 'cancelled' THEN NULL ELSE 'GBP' END AS currency
    FROM raw_events""",
)
