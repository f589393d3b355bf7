"""Presents the given tables in the shape of the domain.

An order is a concert, its customer the artist, the customer's nation the country, the
parts of its lines the songs. Names get stray blanks and case, dates several formats, ids
go missing: what the operators are there to clean up. `oracles.py` states the same in SQL.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.sources import workspace
from tourlens.streaming.live import flag_first_sightings

AS_OF = dt.date(2000, 1, 1)
LOADED_AT = dt.datetime(2012, 1, 1)


def once(make):
    """Build a frame once per `Given`: a plan that uses it twice can then share its shuffles."""

    @functools.wraps(make)
    def built(self, *args, **options):
        key = (make.__name__, args, tuple(sorted(options.items())))
        if key not in self.frames:
            self.frames[key] = make(self, *args, **options)
        return self.frames[key]

    return built


class Given:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.frames = spark, sf_dir, {}

    @once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table_stream(self, name: str) -> DataFrame:
        """The table as a stream; it may be one file or a folder of them."""
        path, file = f"{self.sf_dir}/{name}.parquet", f"{name}.parquet"
        reader = self.spark.readStream.schema(self.table(name).schema)
        if workspace.is_folder(self.spark, path):
            return reader.parquet(path)
        # A stream reads folders, so this one reads the parent and leaves out the other files.
        return reader.option("pathGlobFilter", file).parquet(self.sf_dir)

    # -- shared pieces -----------------------------------------------------------

    @once
    def customers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        return self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))

    @once
    def concerts(self) -> DataFrame:
        """Orders with their customer and nation."""
        return self.table("orders").join(self.customers(), F.col("o_custkey") == F.col("c_custkey"))

    @staticmethod
    def mbid(prefix: str = "C", key: str = "c_custkey") -> Column:
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    @staticmethod
    def venue() -> Column:
        return F.concat("o_orderpriority", F.lit(" hall, "), "n_name")

    @staticmethod
    def status() -> Column:
        return F.when(F.col("o_orderstatus") == "F", "cancelled").when(
            F.col("o_orderstatus") == "O", "onsale"
        )

    @staticmethod
    def artist_type() -> Column:
        group = F.col("c_nationkey") % 5
        return (
            F.when(group == 0, "Group")
            .when(group == 2, "Person")
            .when(group == 3, "Character")
            .when(group == 4, "Orchestra")
        )

    # -- raw tables --------------------------------------------------------------

    @once
    def raw_events(self, copies: bool = False) -> DataFrame:
        """Orders as event rows; with `copies`, each has an older row without artist id."""
        key = F.col("o_orderkey")
        untidy = (
            F.when(key % 3 == 0, F.concat(F.lit("  "), F.upper("c_name")))
            .when(key % 3 == 1, F.concat(F.lower("c_name"), F.lit(" ")))
            .otherwise(F.col("c_name"))
        )
        has_id = (F.col("c_nationkey") % 5 == 3) | (key % 2 == 0)
        rows = self.concerts().select(
            key.cast("string").alias("event_id"),
            F.col("o_orderpriority").alias("event_name"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"),
            untidy.alias("artist_name"),
            F.when(has_id, self.mbid()).alias("artist_mbid"),
            F.concat(F.lit("V"), "c_nationkey", F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias(
                "venue_id"
            ),
            self.venue().alias("venue_name"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("country_code"),
            self.status().alias("event_status"),
            F.col("o_orderdate").cast("timestamp").alias("extracted_at"),
        )
        if not copies:
            return rows
        older = rows.withColumns(
            {
                "artist_mbid": F.lit(None).cast("string"),
                "venue_name": F.lit("elsewhere"),
                "extracted_at": F.col("extracted_at") - F.expr("INTERVAL 1 DAY"),
            }
        )
        return rows.unionByName(older)

    @once
    def raw_artists(self, namesakes: bool = False) -> DataFrame:
        """Customers as artist records, an old and a new one; some have a newer namesake."""
        customers = self.customers()

        def record(mbid, name, kind, genre, at):
            return F.struct(
                name.alias("artist_name"),
                mbid.alias("mbid"),
                F.col("n_name").alias("origin_country"),
                F.lit(None).cast("bigint").alias("formation_year"),
                kind.alias("artist_type"),
                genre.alias("primary_genre"),
                F.lit(at).cast("timestamp").alias("extracted_at"),  # in the session's time zone
            )

        name, genre = F.col("c_name"), F.lower("c_mktsegment")
        records = [
            record(self.mbid(), F.upper(name), self.artist_type(), F.lit("unsorted"), "2000-09-01"),
            record(self.mbid(), name, self.artist_type(), genre, "2001-09-01"),
        ]
        rows = customers.select(F.inline(F.array(*records)))
        if not namesakes:
            return rows
        twin = record(self.mbid("X"), name, F.lit("Group"), F.lit("hip-hop"), "2001-10-01")
        twins = customers.where(F.col("c_mktsegment") == "BUILDING").select(F.inline(F.array(twin)))
        return rows.unionByName(twins)

    @once
    def songs_of_orders(self) -> DataFrame:
        """Song lists, one row per order. An order has a handful of lines."""
        parts = self.table("part").select("p_partkey", "p_name")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "p_name"))).alias("lines"))
        )

    @once
    def concerts_with_songs(self) -> DataFrame:
        songs = self.songs_of_orders()
        return self.concerts().join(songs, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    @once
    def raw_setlists(self, mixed_dates: bool = False) -> DataFrame:
        """Orders as setlists, ten years later so that all are recent enough.

        With `mixed_dates` they stay where they are, some without a readable date.
        """
        day = F.col("o_orderdate").cast("date")
        if mixed_dates:
            form = F.col("o_orderkey") % 4
            text = (
                F.when(form == 0, F.date_format(day, "dd-MM-yyyy"))
                .when(form == 1, F.date_format(day, "yyyy-MM-dd"))
                .when(form == 2, "TBA")
                .otherwise(F.date_format(day, "d-M-yyyy"))
            )
        else:
            later = F.add_months(day, 120)
            text = F.when(
                F.col("o_orderstatus") == "F", F.date_format(later, "dd-MM-yyyy")
            ).otherwise(F.date_format(later, "yyyy-MM-dd"))
        names = F.transform("lines", lambda line: line["p_name"])
        return self.concerts_with_songs().select(
            F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("setlist_id"),
            text.alias("event_date"),
            F.col("c_name").alias("artist_name"),
            self.mbid().alias("artist_mbid"),
            F.col("o_orderpriority").alias("tour_name"),
            self.venue().alias("venue_name"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("country_code"),
            F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("song_count"),
            F.array_join(names, "; ").alias("songs_played"),
            F.col("o_orderdate").cast("timestamp").alias("extracted_at"),
        )

    @once
    def visits(self) -> DataFrame:
        """Line items as concerts: the supplier plays at the part."""
        suppliers = self.table("supplier").select("s_suppkey", "s_name")
        lines = self.table("lineitem").select("l_suppkey", "l_partkey")
        return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("s_name").alias("artist_name"),
            F.concat(F.lit("Venue "), F.col("l_partkey").cast("string")).alias("venue_name"),
        )

    # -- landed documents --------------------------------------------------------

    @once
    def event_pages(self) -> DataFrame:
        """Two pages per order, through JSON text: the listing, and a late one elsewhere."""
        return self.event_page_texts(0, 1).select(F.from_json("value", schemas.EVENT_PAGE).alias("p")).select("p.*")

    def event_page_texts(self, *places: int) -> DataFrame:
        """The pages of some places as JSON text: 0 has the listings, 1 the late ones."""
        key = F.col("o_orderkey")

        def attraction(name, total, kind):
            return F.struct(
                name.alias("name"),
                F.struct(total.cast("bigint").alias("_total")).alias("upcomingEvents"),
                F.array(
                    F.struct(
                        F.struct(kind.alias("name")).alias("type"),
                        F.struct(F.col("c_mktsegment").alias("name")).alias("genre"),
                        F.struct(F.lit("").alias("name")).alias("subGenre"),
                    )
                ).alias("classifications"),
            )

        def page(order, name, status, attractions, venue):
            event = F.struct(
                key.cast("string").alias("id"),
                name.alias("name"),
                F.struct(
                    F.struct(
                        F.date_format("o_orderdate", "yyyy-MM-dd").alias("localDate"),
                        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dateTime"),
                    ).alias("start"),
                    F.struct(status.alias("code")).alias("status"),
                ).alias("dates"),
                F.struct(
                    attractions.alias("attractions"),
                    F.array(
                        F.struct(
                            venue.alias("name"),
                            F.struct(F.col("n_name").alias("name")).alias("city"),
                            F.struct(F.col("n_name").alias("countryCode")).alias("country"),
                        )
                    ).alias("venues"),
                ).alias("_embedded"),
            )
            return F.struct(
                F.lit(order).alias("country_order"),
                F.lit(0).alias("chunk"),
                F.lit(0).alias("page"),
                F.struct(F.array(event).alias("events")).alias("_embedded"),
            )

        kind = F.when(F.col("c_mktsegment") == "BUILDING", "Venue Based").otherwise("Person")
        tour = F.concat("c_name", F.lit(" (US Tour)"))
        billed = F.array(
            attraction(tour, key % 8, kind), attraction(F.lit("Support"), F.lit(9), F.lit("Person"))
        )
        none = F.array().cast(billed_type())
        listed = F.when(F.col("o_orderpriority") == "5-LOW", none).otherwise(billed.cast(billed_type()))
        venue = F.when(
            F.col("o_orderpriority") == "1-URGENT", F.concat("c_name", F.lit(" Arena"))
        ).otherwise(self.venue())
        late = F.array(
            attraction(F.concat(F.lit("Late "), "c_name"), F.lit(5), F.lit("Person"))
        ).cast(billed_type())
        pages = [
            page(0, F.col("o_orderpriority"), self.status(), listed, venue),
            page(1, F.lit("late listing"), self.status(), late, self.venue()),
        ]
        chosen = F.array(*[pages[place] for place in places])
        return self.concerts().select(F.explode(chosen).alias("page")).select(F.to_json("page").alias("value"))

    def setlist_pages(self) -> DataFrame:
        """One page per order, with every shape a set or song list may have."""
        songs = F.transform("lines", lambda line: F.struct(F.concat(F.lit(" "), line["p_name"]).alias("name")))
        n = F.size("songs")

        def with_songs(part):
            return F.concat(F.lit('{"song":'), F.to_json(part), F.lit("}"))

        both = F.concat(
            F.lit("["),
            with_songs(F.slice("songs", 1, 1)),
            F.lit(","),
            with_songs(F.slice("songs", F.lit(2), n)),
            F.lit("]"),
        )
        sets = (
            F.when(n == 1, with_songs(F.get("songs", F.lit(0))))
            .when(F.col("o_orderkey") % 2 == 0, with_songs(F.col("songs")))
            .otherwise(both)
        )
        head = F.to_json(
            F.struct(
                F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("id"),
                F.when(F.col("o_orderstatus") == "P", "")
                .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
                .alias("eventDate"),
                F.struct(
                    self.mbid().alias("mbid"),
                    F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
                ).alias("artist"),
                F.struct(F.col("o_orderpriority").alias("name")).alias("tour"),
                F.struct(
                    self.venue().alias("name"),
                    F.struct(
                        F.col("n_name").alias("name"),
                        F.struct(F.col("n_name").alias("code")).alias("country"),
                    ).alias("city"),
                ).alias("venue"),
            )
        )
        sets_json = F.concat(F.lit(',"sets":{"set":'), F.col("sets_text"), F.lit("}}"))
        document = F.concat(
            F.col("head").substr(F.lit(1), F.length("head") - 1), F.coalesce(sets_json, F.lit("}"))
        )
        listed = F.when(
            F.col("o_orderstatus") == "O", F.concat(F.lit("["), F.col("document"), F.lit("]"))
        ).otherwise(F.col("document"))
        return (
            self.concerts_with_songs()
            .withColumn("songs", songs)
            .withColumns({"sets_text": sets, "head": head})
            .withColumn("document", document)
            .select(
                F.col("c_name").alias("requested_artist"),
                self.mbid().alias("requested_mbid"),
                listed.alias("setlist"),
            )
        )

    def part_searches(self) -> DataFrame:
        """Parts as artist searches that exercise each matching rule."""
        size, key = F.col("p_size"), F.col("p_partkey").cast("string")
        full = F.concat("p_name", F.lit(" "), key)

        def result(prefix, name, tags):
            numbers = F.when(tags > 0, F.sequence(F.lit(1), tags)).otherwise(F.array().cast("array<int>"))
            return F.struct(
                F.concat(F.lit(prefix), key).alias("id"),
                name.alias("name"),
                F.lit("GB").alias("country"),
                F.col("p_type").alias("type"),
                F.lit(None).cast("string").alias("disambiguation"),
                F.struct(
                    F.when(size % 4 == 0, F.concat(F.lit(1950) + size, F.lit("-05"))).alias("begin")
                ).alias("life-span"),
                F.transform(
                    numbers,
                    lambda i: F.struct(
                        F.concat(F.lit("tag"), i.cast("string")).alias("name"),
                        ((i * 7) % 5).cast("bigint").alias("count"),
                    ),
                ).alias("tags"),
            )

        exact = F.when(size % 3 == 0, F.concat(F.lit("The "), F.upper(full))).otherwise(F.col("p_type"))
        results = F.array(
            result("a", F.concat(F.lit("Big "), full), size),
            result("b", F.concat(full, F.lit(" Band")), size % 7),
            result("c", exact, size % 12),
            result("d", F.col("p_name"), size % 20),
            result("e", F.col("p_type"), F.lit(0)),
            result("f", F.when(size % 5 == 0, full).otherwise(F.col("p_type")), size % 12),
            result("g", F.when(size % 7 == 0, F.concat(key, F.lit("00"))).otherwise(F.col("p_name")), F.lit(40)),
        )
        searched = F.when(size % 2 == 0, F.concat(full, F.lit(" (US Tour)"))).otherwise(full)
        return self.table("part").select(searched.alias("searched_name"), results.alias("artists"))

    def customer_searches(self) -> DataFrame:
        """Customers as artist searches; a fifth of them find nobody."""
        result = F.struct(
            self.mbid().alias("id"),
            F.when(F.col("c_nationkey") % 5 == 1, "Nobody").otherwise(F.col("c_name")).alias("name"),
            F.col("n_name").alias("country"),
            self.artist_type().alias("type"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Tribute band").alias("disambiguation"),
            F.struct(F.lit("1998-05").alias("begin")).alias("life-span"),
            F.array(
                F.struct(F.lower("c_mktsegment").alias("name"), F.lit(3).cast("bigint").alias("count"))
            ).alias("tags"),
        )
        return self.customers().select(
            F.col("c_name").alias("searched_name"), F.array(result).alias("artists")
        )

    def cached_resolutions(self) -> DataFrame:
        """Cached artists: current entries for one fifth, outdated ones for another."""
        group = F.col("c_nationkey") % 5
        return self.customers().where(group.isin(2, 4)).select(
            F.lower("c_name").alias("cache_key"),
            F.col("c_name").alias("artist_name"),
            self.mbid("K").alias("mbid"),
            F.lit("XX").alias("origin_country"),
            F.lit(1990).cast("bigint").alias("formation_year"),
            F.lit("Person").alias("artist_type"),
            F.lit("cached").alias("primary_genre"),
            F.array(F.lit("cached")).alias("genres"),
            F.lit(None).cast("string").alias("disambiguation"),
            F.col("c_name").alias("mb_name"),
            F.when(group == 2, 1).alias("cache_version"),
        )

    # -- live log ----------------------------------------------------------------

    @staticmethod
    def as_updates(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("user_id").cast("string").alias("event_id"),
            F.col("event_type").alias("event_name"),
            F.concat(F.lit("Artist "), F.col("user_id").cast("string")).alias("artist_name"),
            F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
            F.col("event_type").alias("event_status"),
            F.col("props").alias("venue_name"),
            F.lit("Town").alias("city"),
            F.lit("GB").alias("country_code"),
            F.col("ts").cast("timestamp").alias("observed_at"),
        )

    @once
    def live_log(self) -> DataFrame:
        return flag_first_sightings(self.as_updates(self.table("events")))


def billed_type() -> str:
    return """ARRAY<STRUCT<name: STRING, upcomingEvents: STRUCT<_total: BIGINT>,
        classifications: ARRAY<STRUCT<type: STRUCT<name: STRING>, genre: STRUCT<name: STRING>,
                                      subGenre: STRUCT<name: STRING>>>>>"""
