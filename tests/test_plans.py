"""Plans: what must reach the scan, and what must not be shuffled whole."""

import datetime as dt

import pytest

from tourlens import schemas
from tourlens.plans import core, marts, similarity, staging
from tourlens.sources.tables import TableStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables on disk, so that plans have scans."""
    root = tmp_path_factory.mktemp("plans")

    def make(name, ddl, partition=None):
        empty = spark.createDataFrame([], ddl).coalesce(1)
        if partition:
            # Partitions are found by their folders, so there has to be one.
            row = tuple(dt.date(2024, 6, 1) if c == partition else None for c in empty.columns)
            spark.createDataFrame([row], ddl).write.partitionBy(partition).parquet(str(root / name))
        else:
            empty.write.parquet(str(root / name))
        return spark.read.schema(ddl).parquet(str(root / name))

    return {
        "fact": make("fact", schemas.FACT_CONCERT, "event_month"),
        "dim": make("dim", schemas.DIM_ARTIST),
        "events": make("events", schemas.RAW_EVENTS),
        "setlists": make("setlists", schemas.RAW_SETLISTS),
        "artists": make("artists", schemas.RAW_ARTISTS),
    }


def test_touring_prunes_months_and_columns(stored):
    text = plan(marts.touring_intensity(stored["fact"], stored["dim"], dt.date(2024, 6, 15)))
    scan = next(line for line in text.splitlines() if "source" in line and "FileScan" in line)
    assert "event_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-06-01" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(source,ticketmaster)" in scan
    assert "songs_played" not in scan and "venue_name" not in scan


def test_one_source_reads_one_branch_of_the_union(stored):
    unified = staging.concerts_unified(
        staging.stg_events(stored["events"], stored["artists"]), staging.stg_setlists(stored["setlists"])
    )
    text = plan(unified.where("source = 'setlistfm'"))
    assert text.count("FileScan") == 1 and "Union" not in text


def test_dedup_cuts_before_the_shuffle(stored):
    text = plan(staging.stg_events(stored["events"], stored["artists"]))
    for part in text.split("Exchange hashpartitioning(event_id")[1:]:
        assert "WindowGroupLimit [event_id" in part


def test_fallback_artists_use_an_anti_join(stored):
    assert "LeftAnti" in plan(core.artists_combined(stored["artists"], stored["events"]))


def test_no_cross_joins(stored):
    for df in (
        similarity.venue_similarity(stored["fact"]),
        marts.yearly_repertoire(stored["fact"], stored["dim"]),
        marts.setlist_freshness(stored["fact"], stored["dim"]),
    ):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_similarity_without_detail_collects_nothing(stored):
    assert "collect_list" not in plan(similarity.venue_similarity(stored["fact"], with_detail=False))
    assert "Sort [jaccard" not in plan(similarity.venue_similarity(stored["fact"]))


def test_loads_push_the_watermark_to_the_scan(spark, stored, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    mark = spark.createDataFrame([(dt.datetime(2024, 6, 1),)], schemas.WATERMARK)
    for table in ("dim_artist", "fact_concert"):
        store.overwrite(table, spark.createDataFrame([], core.TABLES[table].ddl).coalesce(1))
        store.overwrite(f"{table}_watermark", mark)
    events, _ = core.due_concerts(store, stored["events"], stored["setlists"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        scans = [line for line in plan(events).splitlines() if "FileScan" in line and "event_id" in line]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) == 3
    new, keys, rows = (scans[0], *sorted(scans[1:], key=len))
    assert "PushedFilters: [Or(GreaterThanOrEqual(extracted_at,2024-06-01" in new
    assert "LessThan(extracted_at,2024-06-01" in keys.split("PushedFilters")[1] and "LessThan(extracted_at" in rows.split("PushedFilters")[1]
    assert "artist_name" not in keys  # late rows are found by their keys
    assert "LeftAnti" in plan(events) and "LeftSemi" in plan(events)
