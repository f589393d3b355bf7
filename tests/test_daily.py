"""The whole way: landed files to marts, twice, then the snapshots."""

import datetime as dt
import json

import pytest
from conftest import dicts
from pyspark.sql import functions as F
from test_landing import attraction, event, setlist
from test_matching import _whole, found

from tourlens import schemas
from tourlens.operators.quality import CheckFailed
from tourlens.plans import daily, export, ingest
from tourlens.sources import landing
from tourlens.sources.tables import TABLES, TableStore, parameter_list

AS_OF, NOW = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 9)

EVENTS = [
    event("m1", [attraction("Muse (US Tour)")]),
    event("m2", [attraction("MUSE")], country="US"),
    event("r1", [attraction("Radiohead")]),
    event("t1", [attraction("ABBA Tribute")]),
    event("c1", [attraction("Cover Act")]),
    event("n1", [attraction("Nobody Knows")]),
    event("late", [attraction("Muse")], day="2026-01-01"),
]
SEARCHES = [
    ("Muse", [found("Muse", "mm", type="Group")]),
    ("MUSE", [found("Muse", "mm", type="Group")]),
    ("Radiohead", [found("Radiohead", "rr", type="Group")]),
    ("Cover Act", [found("Cover Act", "cc", disambiguation="a covers band")]),
    ("ABBA Tribute", [found("ABBA Tribute", "tt")]),
]
SETLISTS = [
    ("Muse", "mm", setlist("s1", {"set": {"song": [{"name": "A"}, {"name": "B"}]}}, "05-05-2019", artist={"mbid": "mm", "name": "Muse"})),
    ("Muse", "mm", setlist("s2", {"set": {"song": [{"name": "A"}, {"name": "C"}]}}, "05-05-2020", artist={"mbid": "mm", "name": "Muse"})),
    ("Radiohead", "rr", setlist("s3", {"set": {"song": {"name": "X"}}}, "05-05-2020", artist={"mbid": "rr", "name": "Radiohead"})),
    ("Cover Act", "cc", setlist("s4", artist={"mbid": "cc", "name": "Cover Act"})),
]


@pytest.fixture
def landed(spark, tmp_path, frame):
    def make(events=EVENTS):
        for name, docs in {
            "events": [{"country_order": 0, "chunk": 0, "page": 0, "_embedded": {"events": events}}],
            "setlists": [{"requested_artist": a, "requested_mbid": m, "setlist": s} for a, m, s in SETLISTS],
            "searches": [{"searched_name": n, "artists": [_whole(a) for a in found_list]} for n, found_list in SEARCHES],
        }.items():
            (tmp_path / name).mkdir(exist_ok=True)
            (tmp_path / name / "0.json").write_text("\n".join(json.dumps(d) for d in docs))
        return {
            "event_pages": landing.read_event_pages(spark, str(tmp_path / "events")),
            "setlist_pages": landing.read_setlist_pages(spark, str(tmp_path / "setlists")),
            "searches": landing.read_artist_searches(spark, str(tmp_path / "searches")),
        }

    return make


def run_ingest(store, landed, **more):
    options = {"mode": "production", "countries": ["GB", "US"], "as_of": AS_OF, "extracted_at": NOW}
    return ingest.ingest(**landed, cache=store.read("artist_resolution"), **(options | more))


def test_build(spark, tmp_path, landed):
    store = TableStore(spark, str(tmp_path / "store"))
    result = run_ingest(store, landed())
    counts = {r.table_name: r.n for r in ingest.dry_run(result.tables()).collect()}
    assert counts == {"ticketmaster_events": 3, "setlistfm_setlists": 3, "musicbrainz_artists": 3}
    assert not store.exists("ticketmaster_events")
    metrics = {(r["stage"], r["outcome"]): r["n"] for r in dicts(result.metrics())}
    assert metrics["events", "show_name"] == 1 and metrics["events", "outside_window"] == 1
    assert metrics["artists", "verified"] == 2 and metrics["artists", "tribute"] == 1

    daily.run(store, result, AS_OF, NOW)
    touring = {(r["artist_name"], r["country"]): r["concert_count"] for r in dicts(store.read("mart_artist_touring_intensity"))}
    # Of two spellings with equal counts the first by name stands for the artist.
    assert touring == {("MUSE", "GB"): 1, ("MUSE", "US"): 1, ("Radiohead", "GB"): 1}
    fresh = {(r["artist_name"], r["concert_year"]): r["freshness_pct"] for r in dicts(store.read("mart_artist_setlist_freshness"))}
    assert fresh == {("MUSE", 2019): 100.0, ("MUSE", 2020): 50.0, ("Radiohead", 2020): 100.0}
    assert [(r["artist_a"], r["artist_b"]) for r in dicts(store.read("spark_artist_similarity"))] == [("MUSE", "Radiohead")]

    # The second day (a name never searched is not cached): one event moves, one is called off; artists come from the cache.
    assert store.read("artist_resolution").count() == 3
    moved = [event("m1", [attraction("Muse")], day="2024-09-09"), event("r1", [attraction("Radiohead")], status="cancelled")]
    second = run_ingest(store, landed(moved), stored_setlists=store.read("setlistfm_setlists"))
    assert second.setlists.count() == 0 and second.cache.count() == 0
    daily.run(store, second, AS_OF, NOW)
    fact = {r["concert_id"]: r["event_date"] for r in dicts(store.read("fact_concert"))}
    assert len(fact) == 6 and fact["m1"] == dt.date(2024, 9, 9)

    out = str(tmp_path / "snapshots")
    outcome = export.export_snapshots(spark, store.read, out, AS_OF)
    assert set(outcome.values()) == {"exported"} and len(outcome) == 6
    assert export.is_fresh(spark, out, AS_OF) and not export.is_fresh(spark, out, dt.date(2024, 1, 2))
    shown = spark.read.parquet(f"{out}/date_range").first()
    assert (shown.min_date, shown.max_date) == (dt.datetime(2024, 6, 1), dt.datetime(2024, 9, 9))

    def broken(name):
        if name == "spark_artist_similarity":
            raise LookupError(name)
        return store.read(name)

    assert export.export_snapshots(spark, broken, out, AS_OF)["similarity"].startswith("skipped")
    assert not (tmp_path / "snapshots" / "similarity").exists()


def test_a_failing_check_stops_the_build(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path / "store"))
    row = {"event_id": "e", "artist_name": "A", "country_code": "GB", "event_date": "someday", "extracted_at": NOW}
    store.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, [row]))
    with pytest.raises(CheckFailed, match="event_date"):
        daily.run(store, None, AS_OF, NOW)
    assert not store.exists("mart_artist_touring_intensity")


def test_bad_raw_rows_leave_the_stored_core_untouched(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path / "store"))
    good = {"event_id": "e", "artist_name": "A", "artist_mbid": "m", "country_code": "GB", "event_date": "2024-05-05", "extracted_at": NOW}
    store.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, [good]))
    daily.run(store, None, AS_OF, NOW)
    before = {t: store.current(t) for t in ("dim_artist", "fact_concert")}
    rows = {t: sorted(store.read(t).collect()) for t in before}
    assert len(rows["fact_concert"]) == 1
    bad = good | {"event_id": "b", "artist_mbid": "n", "event_date": "someday"}
    store.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, [good | {"city": "moved"}, bad]))
    with pytest.raises(CheckFailed, match=r"stg_events.event_date.not_null: 1$"):
        daily.run(store, None, AS_OF, NOW)
    assert {t: store.current(t) for t in before} == before
    assert {t: sorted(store.read(t).collect()) for t in before} == rows


@pytest.mark.parametrize("table", ["dim_artist", "fact_concert"])
def test_a_bad_dimension_or_fact_is_never_published(spark, tmp_path, frame, monkeypatch, table):
    store = TableStore(spark, str(tmp_path / "store"))
    good = {"event_id": "e", "artist_name": "A", "artist_mbid": "m", "country_code": "GB", "event_date": "2024-05-05", "extracted_at": NOW}
    store.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, [good]))
    daily.run(store, None, AS_OF, NOW)
    before = {t: (store.current(t), sorted(store.read(t).collect())) for t in ("dim_artist", "fact_concert", "dim_artist_watermark", "fact_concert_watermark")}
    loads = {t: sorted((tmp_path / "store" / t).glob("load=*")) for t in before}
    bad = {"event_id": "b", "artist_mbid": "n", "country_code": "GB", "event_date": "2024-06-06", "extracted_at": NOW + dt.timedelta(days=1)}
    if table == "fact_concert":
        bad |= {"artist_name": "B", "event_date": "2044-06-06"}  # too far ahead
    store.upsert("ticketmaster_events", frame(schemas.RAW_EVENTS, [bad]))
    with pytest.raises(CheckFailed, match=table):
        daily.run(store, None, AS_OF, NOW)
    assert {t: (store.current(t), sorted(store.read(t).collect())) for t in before} == before
    assert {t: sorted((tmp_path / "store" / t).glob("load=*")) for t in before} == loads


def test_prototype_mode(spark, tmp_path, landed):
    store = TableStore(spark, str(tmp_path / "store"))
    tracked = parameter_list(spark, ingest.TRACKED_ARTISTS + ",Muse", "artist_name")
    result = run_ingest(store, landed(), mode="prototype", tracked=tracked, countries=["GB"])
    assert sorted(r["event_id"] for r in dicts(result.events)) == ["m1", "r1"]
    result = run_ingest(store, landed(), mode="prototype", tracked=tracked)
    assert sorted(r["event_id"] for r in dicts(result.events)) == ["m1", "m2", "r1"]
    with pytest.raises(ValueError):
        run_ingest(store, landed(), mode="prototype")
    with pytest.raises(ValueError):
        run_ingest(store, landed(), mode="other")


def test_candidates(frame):
    names = ["B", "A", " A ", "C", "C", "ABBA Tribute", "", None]
    events = frame(schemas.RAW_EVENTS, [{"event_id": str(i), "artist_name": n} for i, n in enumerate(names)])
    got = [(r.artist_name, r.event_count) for r in ingest.touring_candidates(events, 3).collect()]
    assert got == [("A", 2), ("C", 2), ("B", 1)]


def test_registry_schemas_parse(spark):
    for name, table in TABLES.items():
        columns = spark.createDataFrame([], table.ddl).columns
        assert set(table.key) <= set(columns), name
        assert spark.createDataFrame([], table.ddl).select(F.count("*")).first()[0] == 0


def test_kept_events_are_sorted_out_once(spark, tmp_path, landed):
    store = TableStore(spark, str(tmp_path / "store"))
    with run_ingest(store, landed()) as result:
        assert "Window" not in result.events._jdf.queryExecution().optimizedPlan().toString()
        assert result.events.count() == 3
