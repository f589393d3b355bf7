"""The registered queries against their SQL oracles, and against brute force."""

import datetime as dt

import duckdb
import pytest
from conftest import GIVEN
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tourlens.driver import queries, tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# One query per area here; the others run the same operators.
CHECKED = [
    "stg_events",
    "stg_setlists",
    "dim_artist",
    "touring_intensity",
    "yearly_repertoire",
    "setlist_freshness",
    "venue_similarity",
    "similar_artists_top10",
    "artist_evolution",
    "live_metrics",
    "stream_first_seen",
    "flatten_events",
    "flatten_setlists",
    "resolve_artists",
    "verified_events",
    "name_normalised",
    "quality_report",
    "upsert_events",
    "incremental_fact",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{GIVEN}/{table}.parquet'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_oracle(spark, duck, name):
    df = entry.queries()[name](spark, GIVEN)
    ours = by_name(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    theirs = by_name([d[0] for d in cursor.description], cursor.fetchall())
    assert ours == theirs
    assert ours[1]


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["artist_name", "primary_genre", "country", "concert_count"]
    assert df.count() > 0


def test_oracle_dates_are_fixed():
    today = dt.date.today().isoformat()
    for sql in entry.oracle_sql().values():
        assert "current_" not in sql.lower() and today not in sql


def test_the_stream_reads_tables_of_many_files(spark, tmp_path):
    events = spark.read.parquet(f"{GIVEN}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    log = entry.queries()["stream_first_seen"](spark, str(tmp_path))
    assert log.count() == events.count()
    assert log.where("is_new").count() == events.select("user_id").distinct().count()


def test_pages_are_landed_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    given = tables.Given(spark, GIVEN)
    monkeypatch.setattr(queries, "LANDED", {**queries.LANDED, "maxRecordsPerFile": 1000})
    pages, setlists, searches = queries._landed(given)
    files = pages.inputFiles() + setlists.inputFiles() + searches.inputFiles()
    assert all(file.endswith(".lz4") for file in files) and len(pages.inputFiles()) >= given.event_pages().count() / 1000
    for landed, made in ((pages, given.event_pages()), (setlists, given.setlist_pages()), (searches, given.customer_searches())):
        shared = made.select(*[c for c in landed.columns if c in made.columns])
        assert sorted(map(str, landed.select(F.to_json(F.struct(*shared.columns))).collect())) == sorted(
            map(str, shared.select(F.to_json(F.struct(*shared.columns))).collect())
        )
    one = given.event_page_texts(1).select(F.from_json("value", "country_order INT")["country_order"]).distinct().collect()
    assert [tuple(r) for r in one] == [(1,)]
