import datetime as dt

import pytest
from conftest import dicts

from tourlens import schemas
from tourlens.plans import core
from tourlens.sources.tables import TableStore

T1, T2, T3, T4 = (dt.datetime(2024, m, 1) for m in (1, 2, 3, 4))


def artist(mbid, name, at=T1, **more):
    return {"mbid": mbid, "artist_name": name, "extracted_at": at} | more


def concert(concert_id, mbid=None, at=T1, day=dt.date(2024, 5, 5), **more):
    base = {"concert_id": concert_id, "artist_mbid": mbid, "artist_name": "raw", "event_date": day}
    return base | {"source": "ticketmaster", "extracted_at": at} | more


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def test_dimension(frame):
    types = [None, "Person", "Group", "Orchestra", "Choir", "Character", ""]
    artists = [artist(f"t{i}", f"n{i}", artist_type=t) for i, t in enumerate(types)]
    artists += [artist("twice", "old", T1, primary_genre="a"), artist("twice", "new", T2, primary_genre="b")]
    artists += [artist(None, "no id")]
    events = [
        {"event_id": "1", "artist_mbid": "ev", "artist_name": "older", "extracted_at": T1},
        {"event_id": "2", "artist_mbid": "ev", "artist_name": "newer", "extracted_at": T2},
        {"event_id": "3", "artist_mbid": "twice", "artist_name": "from event", "extracted_at": T3},
        {"event_id": "4", "artist_mbid": "t5", "artist_name": "comes back", "extracted_at": T1},
    ]
    dim = core.dim_artist(frame(schemas.RAW_ARTISTS, artists), frame(schemas.RAW_EVENTS, events), T4)
    got = {r["artist_id"]: (r["artist_name"], r["primary_genre"]) for r in dicts(dim)}
    assert got == {
        "t0": ("n0", None),
        "t1": ("n1", None),
        "t2": ("n2", None),
        "t3": ("n3", None),
        "t4": ("n4", None),
        "twice": ("new", "b"),
        "ev": ("newer", None),
        # Its type keeps it out, its event brings it back without a genre.
        "t5": ("comes back", None),
    }


def test_fact_links_and_falls_back(frame):
    dim = frame(schemas.DIM_ARTIST, [{"artist_id": "m", "mbid": "m", "artist_name": "Muse"}])
    fact = core.fact_concert(
        frame(schemas.CONCERTS_UNIFIED, [concert("a", "m"), concert("b", "x"), concert("c")]), dim, T4
    )
    got = {r["concert_id"]: r for r in dicts(fact)}
    assert (got["a"]["artist_id"], got["a"]["artist_name"]) == ("m", "Muse")
    assert (got["b"]["artist_id"], got["b"]["artist_name"]) == (None, "raw")
    assert (got["c"]["artist_id"], got["c"]["event_month"]) == (None, dt.date(2024, 5, 1))


def names(df):
    return {r["artist_id"]: r["artist_name"] for r in dicts(df)}


def test_dimension_loads_late_rows_unless_strict(frame, store):
    none = frame(schemas.RAW_EVENTS, [])

    def raw(*artists):
        return frame(schemas.RAW_ARTISTS, list(artists))

    core.load_dim_artist(store, raw(artist("a", "A", T1)), none, T3)
    late = raw(artist("b", "B", T2), artist("a", "A2", T2))
    strict = core.load_dim_artist(store, late, none, T3, strict_reference=True)
    assert names(strict) == {"a": "A"}
    assert names(core.load_dim_artist(store, late, none, T3)) == {"a": "A2", "b": "B"}
    # Stamped before the newest row seen, but not stored yet.
    later = core.load_dim_artist(store, raw(artist("c", "C", T1)), none, T3)
    assert names(later) == {"a": "A2", "b": "B", "c": "C"}
    after = raw(artist("d", "D", T4))
    assert "d" in names(core.load_dim_artist(store, after, none, T4, strict_reference=True))


def test_strict_loads_into_an_empty_table(frame, store):
    none, artists = frame(schemas.RAW_EVENTS, []), frame(schemas.RAW_ARTISTS, [artist("a", "A")])
    store.overwrite("dim_artist", frame(schemas.DIM_ARTIST, []).coalesce(1))
    store.overwrite("fact_concert", frame(schemas.FACT_CONCERT, []).coalesce(1))
    assert core.load_dim_artist(store, artists, none, T3, strict_reference=True).count() == 1
    unified = frame(schemas.CONCERTS_UNIFIED, [concert("x")])
    dim = store.read("dim_artist")
    assert core.load_fact_concert(store, unified, dim, T3, strict_reference=True).count() == 0
    assert core.load_fact_concert(store, unified, dim, T3).count() == 1


def test_called_off_concerts_stay_unless_removed(frame, store):
    dim = frame(schemas.DIM_ARTIST, [])
    raw = frame(
        schemas.RAW_EVENTS,
        [
            {"event_id": "x", "event_status": "onsale", "extracted_at": T1},
            {"event_id": "x", "event_status": "cancelled", "extracted_at": T2},
            {"event_id": "y", "event_status": "cancelled", "extracted_at": T1},
            {"event_id": "y", "event_status": "onsale", "extracted_at": T2},
        ],
    )
    both = frame(schemas.CONCERTS_UNIFIED, [concert("x"), concert("y")])
    core.load_fact_concert(store, both, dim, T3)
    left = frame(schemas.CONCERTS_UNIFIED, [concert("y")])
    assert core.load_fact_concert(store, left, dim, T3).count() == 2
    kept = core.load_fact_concert(store, left, dim, T3, removed=core.called_off(raw))
    assert [r["concert_id"] for r in dicts(kept)] == ["y"]


def test_unlinked_concerts_are_linked_later(frame, store):
    unified = frame(schemas.CONCERTS_UNIFIED, [concert("x", "m", T1), concert("y", None, T2)])
    empty = frame(schemas.DIM_ARTIST, [])
    core.load_fact_concert(store, unified, empty, T3)
    dim = frame(schemas.DIM_ARTIST, [{"artist_id": "m", "mbid": "m", "artist_name": "Muse"}])
    strict = core.load_fact_concert(store, unified, dim, T3, strict_reference=True)
    assert {r["artist_id"] for r in dicts(strict)} == {None}
    linked = core.load_fact_concert(store, unified, dim, T3)
    assert {r["concert_id"]: r["artist_id"] for r in dicts(linked)} == {"x": "m", "y": None}


def test_a_load_takes_stored_concerts_again_only_if_they_link_now(frame, store):
    rows = [concert("old", "unknown", T1, dt.date(2024, 1, 1)), concert("links", "m", T1), concert("none", None, T1)]
    unified = frame(schemas.CONCERTS_UNIFIED, [*rows, concert("newest", None, T2, dt.date(2024, 8, 8))])
    core.load_fact_concert(store, unified, frame(schemas.DIM_ARTIST, []), T3)
    dim = frame(schemas.DIM_ARTIST, [{"artist_id": "m", "mbid": "m", "artist_name": "Muse"}])
    again = {r["concert_id"]: r for r in dicts(core.load_fact_concert(store, unified, dim, T4))}
    assert {i: r["artist_id"] for i, r in again.items()} == {"old": None, "links": "m", "none": None, "newest": None}
    assert {i for i, r in again.items() if r["loaded_at"] == T4} == {"links", "newest"}


def test_two_halves_equal_one_build(frame, store, spark, tmp_path):
    dim = frame(schemas.DIM_ARTIST, [{"artist_id": "m", "mbid": "m", "artist_name": "Muse"}])
    rows = [
        concert(str(i), "m" if i % 2 else None, T1 + dt.timedelta(days=i % 5), dt.date(2024, 1 + i % 9, 3))
        for i in range(40)
    ]
    whole = TableStore(spark, str(tmp_path / "whole"))
    once = core.load_fact_concert(whole, frame(schemas.CONCERTS_UNIFIED, rows), dim, T4)
    core.load_fact_concert(store, frame(schemas.CONCERTS_UNIFIED, rows[:17]), dim, T4)
    core.load_fact_concert(store, frame(schemas.CONCERTS_UNIFIED, rows[17:]), dim, T4)
    again = core.load_fact_concert(store, frame(schemas.CONCERTS_UNIFIED, rows), dim, T4)
    assert sorted(again.collect()) == sorted(once.collect())
    full = core.load_fact_concert(store, frame(schemas.CONCERTS_UNIFIED, rows[:3]), dim, T4, full_refresh=True)
    assert full.count() == 3
