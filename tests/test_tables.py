import datetime as dt
import os

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.operators.keyed import best_per_key, latest_per_key, lookup
from tourlens.sources import tables
from tourlens.sources.tables import TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def fact(frame, *rows):
    made = [
        {"concert_id": c, "event_date": d, "event_month": d and d.replace(day=1), "city": city}
        for c, d, city in rows
    ]
    return frame(schemas.FACT_CONCERT, made)


def stored(df):
    return sorted((r["concert_id"], str(r["event_date"]), r["city"]) for r in dicts(df))


JAN, FEB, MAR = dt.date(2024, 1, 9), dt.date(2024, 2, 9), dt.date(2024, 3, 9)


def test_upsert_moves_months(frame, store):
    store.overwrite("fact_concert", fact(frame, ("a", JAN, "x"), ("b", JAN, "x"), ("c", FEB, "x"), ("d", MAR, "x")))
    first = stored(store.read("fact_concert"))
    assert stored(store.upsert("fact_concert", fact(frame, ("a", JAN, "x"), ("c", FEB, "x")))) == first
    # One row of January and the only one of February move to March, one to no date.
    got = store.upsert("fact_concert", fact(frame, ("a", MAR, "y"), ("c", MAR, "y"), ("b", None, "y")))
    assert stored(got) == [
        ("a", "2024-03-09", "y"),
        ("b", "None", "y"),
        ("c", "2024-03-09", "y"),
        ("d", "2024-03-09", "x"),
    ]
    assert sorted(store.current("fact_concert").cells) == ["event_month=2024-03-01", "event_month=__HIVE_DEFAULT_PARTITION__"]
    # Back from no date, and one removed.
    gone = frame("concert_id STRING", [{"concert_id": "d"}])
    got = store.upsert("fact_concert", fact(frame, ("b", FEB, "z")), removed=gone)
    assert [r[0] for r in stored(got)] == ["a", "b", "c"]


def files(store, name):
    """Data files of each current cell."""
    now = store.current(name)
    at = {c: os.path.join(store.root, name, f"load={load}", c) for c, load in now.cells.items()}
    return {c: sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) for c, folder in at.items()}


def test_untouched_months_keep_their_files(frame, store):
    store.overwrite("fact_concert", fact(frame, ("a", JAN, "x"), ("b", FEB, "x")))
    before = files(store, "fact_concert")
    store.upsert("fact_concert", fact(frame, ("b", FEB, "y"), ("n", FEB, "y")))
    after = files(store, "fact_concert")
    assert after["event_month=2024-01-01"] == before["event_month=2024-01-01"]
    assert after["event_month=2024-02-01"] != before["event_month=2024-02-01"]


def test_untouched_buckets_keep_their_files(frame, store):
    rows = [{"event_id": str(i), "city": "x"} for i in range(200)]
    store.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, rows))
    before = files(store, "ticketmaster_events")
    assert len(before) == tables.BUCKETS
    got = store.upsert("ticketmaster_events", frame(schemas.RAW_EVENTS, [{"event_id": "7", "city": "y"}]))
    assert sorted((r.event_id, r.city) for r in got.select("event_id", "city").collect()) == sorted((str(i), "y" if i == 7 else "x") for i in range(200))
    after = files(store, "ticketmaster_events")
    assert sum(before[c] != after[c] for c in before) == 1
    # A bucket that loses its last row is no cell any more.
    gone = frame("event_id STRING", [{"event_id": str(i)} for i in range(200)])
    assert store.upsert("ticketmaster_events", frame(schemas.RAW_EVENTS, []), removed=gone).count() == 0
    assert store.current("ticketmaster_events").cells == {}
    few = TableStore(store.spark, store.root + "-few", buckets=3)
    few.overwrite("ticketmaster_events", frame(schemas.RAW_EVENTS, rows))
    assert len(few.current("ticketmaster_events").cells) == 3 and few.read("ticketmaster_events").count() == 200


def test_a_failure_before_the_switch_changes_nothing(frame, store, monkeypatch):
    store.overwrite("fact_concert", fact(frame, ("a", JAN, "x"), ("b", FEB, "x")))
    before = stored(store.read("fact_concert"))

    def broken(*_):
        raise OSError("no switch")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "_switch", broken)
        with pytest.raises(OSError):
            store.upsert("fact_concert", fact(frame, ("a", FEB, "y"), ("c", MAR, "y")))
    assert stored(store.read("fact_concert")) == before
    got = store.upsert("fact_concert", fact(frame, ("a", FEB, "y"), ("c", MAR, "y")))
    assert [r[0] for r in stored(got)] == ["a", "b", "c"]


def test_old_loads_go_once_no_reader_follows_them(frame, store):
    root = os.path.join(store.root, "fact_concert")
    store.overwrite("fact_concert", fact(frame, ("a", JAN, "x"), ("b", FEB, "x")))
    open_ = store.read("fact_concert")
    store.upsert("fact_concert", fact(frame, ("b", FEB, "y")))
    assert stored(open_) == [("a", "2024-01-09", "x"), ("b", "2024-02-09", "x")]
    for city in "zuvw":
        store.upsert("fact_concert", fact(frame, ("b", FEB, city)))
    loads = [d for d in os.listdir(root) if d.startswith("load=")]
    held = {f"load={load}" for load in store.current("fact_concert").cells.values()}
    assert held <= set(loads) and len(loads) == 3  # January's, and February's now and before
    assert len(os.listdir(os.path.join(root, "_pointers"))) <= 4  # two pointers and their checksums


def test_a_draft_is_seen_by_nobody_until_published(frame, store):
    store.overwrite("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "a"}]))
    draft = store.draft()
    draft.upsert("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "b"}]))
    draft.upsert("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "c"}]))
    assert draft.read("dim_artist").count() == 3 and store.read("dim_artist").count() == 1
    draft.discard()
    assert store.read("dim_artist").count() == 1 and draft.read("dim_artist").count() == 1
    draft.upsert("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "b"}]))
    draft.overwrite("fact_concert", fact(frame, ("a", JAN, "x")))
    draft.publish()
    assert store.read("dim_artist").count() == 2 and store.read("fact_concert").count() == 1


def test_raw_tables_grow_by_columns(frame, store):
    store.overwrite("ticketmaster_events", frame("event_id STRING, city STRING", [{"event_id": "1", "city": "A"}]))
    new = frame("event_id STRING, currency STRING", [{"event_id": "2", "currency": "GBP"}])
    got = {r["event_id"]: r for r in dicts(store.upsert("ticketmaster_events", new))}
    assert got["1"] == {"event_id": "1", "city": "A", "currency": None}
    assert got["2"] == {"event_id": "2", "city": None, "currency": "GBP"}


def test_core_tables_follow_their_schema(frame):
    old = frame("artist_id STRING, spotify_id STRING", [{"artist_id": "a", "spotify_id": "s"}])
    got = tables.with_columns_of(old, schemas.DIM_ARTIST)
    assert got.columns == ["artist_id", "mbid", "artist_name", "primary_genre", "_loaded_at"]
    assert got.first().mbid is None


def test_a_failed_write_stays_invisible(frame, store):
    store.overwrite("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "a"}]))
    os.makedirs(os.path.join(store.root, "dim_artist", "load=unfinished", "bucket=1"))
    assert store.read("dim_artist").count() == 1
    assert store.overwrite("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "b"}] * 2)).count() == 2
    # A rewrite may read what it replaces.
    assert store.overwrite("dim_artist", store.read("dim_artist").limit(1)).count() == 1


def test_reset_needs_confirmation(frame, store, spark):
    store.overwrite("dim_artist", frame(schemas.DIM_ARTIST, [{"artist_id": "a"}]))
    store.register_views(["dim_artist"])
    assert tables.read_optional_table(spark, "dim_artist").count() == 1
    with pytest.raises(ValueError):
        store.reset(["dim_artist"], ["dim_artist"])
    assert store.read("dim_artist").count() == 1
    store.reset(["dim_artist", "fact_concert"], ["dim_artist"], confirm=True)
    assert store.exists("dim_artist") and store.read("dim_artist").count() == 0
    assert store.read("fact_concert").count() == 0
    assert tables.read_optional_table(spark, "dim_artist") is None


def test_missing_snapshots(spark, tmp_path):
    path = str(tmp_path / "none")
    empty = tables.read_or_empty(spark, path, schemas.TOURING_INTENSITY)
    assert empty.columns[0] == "artist_name" and empty.count() == 0
    assert tables.read_optional(spark, path, schemas.TOURING_INTENSITY) is None


def test_parameter_list(spark):
    got = tables.parameter_list(spark, '"Coldplay, Radiohead,,Arctic Monkeys"', "artist_name")
    assert [r[0] for r in got.orderBy("position").collect()] == ["Coldplay", "Radiohead", "Arctic Monkeys"]
    assert tables.parameter_list(spark, "US,CA", "country").count() == 2


def test_keyed_operators(frame):
    df = frame("k STRING, at INT, v STRING", [
        {"k": "a", "at": 1, "v": "x"}, {"k": "a", "at": 2, "v": "z"}, {"k": "a", "at": 2, "v": "y"},
        {"k": "b", "v": "n"},
    ])
    assert sorted(r.v for r in latest_per_key(df, ["k"], "at", ["v"]).collect()) == ["n", "y"]
    assert sorted(r.v for r in best_per_key(df, ["k"], [F.col("v").asc()]).collect()) == ["n", "x"]
    side = frame("id STRING, w INT", [{"id": "x", "w": 1}, {"id": None, "w": 2}])
    rows = frame("id STRING, n STRING", [{"id": "x", "n": "1"}, {"n": "2"}, {"id": "q", "n": "3"}])
    got = lookup(rows, F.col("id"), side, "id", F.col("n"))
    assert sorted((r.n, r.w) for r in got.collect()) == [("1", 1), ("2", None), ("3", None)]


def test_best_per_key_cuts_before_the_shuffle(spark):
    df = best_per_key(spark.range(100).selectExpr("id % 3 AS k", "id AS v"), ["k"], [F.col("v").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:], plan
