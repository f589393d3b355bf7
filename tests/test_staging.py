import datetime as dt

from conftest import dicts

from tourlens import schemas
from tourlens.plans import staging

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def event(event_id, name="Muse", **more):
    return {"event_id": event_id, "artist_name": name, "event_date": "2024-06-01", "extracted_at": T1} | more


def artist(mbid, name="Muse", at=T1, **more):
    return {"mbid": mbid, "artist_name": name, "extracted_at": at} | more


def staged(frame, events, artists):
    rows = staging.stg_events(frame(schemas.RAW_EVENTS, events), frame(schemas.RAW_ARTISTS, artists))
    return {r["concert_id"]: r for r in dicts(rows)}


def test_one_row_per_event_with_the_right_id(frame):
    got = staged(
        frame,
        [
            event("own", artist_mbid="mine"),
            event("newest"),
            event("nulls", "Radiohead"),
            event("none", "Nobody"),
            event("blank", None),
        ],
        [
            artist("old", at=T1),
            artist("new", " MUSE ", at=T2),
            artist("stamped", "Radiohead", at=T1),
            artist("unstamped", "radiohead", at=None),
        ],
    )
    assert {k: v["artist_mbid"] for k, v in got.items()} == {
        "own": "mine",
        "newest": "new",
        "nulls": "stamped",
        "none": None,
        "blank": None,
    }


def test_double_events_prefer_the_one_with_an_id(frame):
    got = staged(
        frame,
        [event("e", city="A"), event("e", city="B", artist_mbid="m", extracted_at=T1), event("e", city="C", extracted_at=T3)],
        [artist("x")],
    )
    assert len(got) == 1 and got["e"]["city"] == "B"


def test_status_filter_is_case_sensitive_and_keeps_unknown(frame):
    states = [None, "", "onsale", "cancelled", "postponed", "Cancelled"]
    got = staged(frame, [event(str(i), event_status=s) for i, s in enumerate(states)], [])
    assert sorted(got) == ["0", "1", "2", "5"]


def test_name_match_ignores_case_and_any_blanks(frame):
    got = staged(frame, [event("1", "  Coldplay "), event("2", "Coldplay ")], [artist("c", "COLDPLAY")])
    assert {r["artist_mbid"] for r in got.values()} == {"c"}


def test_setlist_dates(frame):
    texts = ["31-12-2020", "2020-12-31", "1-2-2020", "31-02-2020", "2020", "", None, "31-12-1999", "01-01-2000"]
    raw = frame(schemas.RAW_SETLISTS, [{"setlist_id": str(i), "event_date": t} for i, t in enumerate(texts)])
    got = {r["setlist_id"]: r["event_date"] for r in dicts(staging.stg_setlists(raw))}
    assert got == {
        "0": dt.date(2020, 12, 31),
        "1": dt.date(2020, 12, 31),
        "2": dt.date(2020, 2, 1),
        "8": dt.date(2000, 1, 1),
    }


def test_union_pads_and_tags(frame):
    events = staging.stg_events(frame(schemas.RAW_EVENTS, [event("e")]), frame(schemas.RAW_ARTISTS, []))
    setlists = staging.stg_setlists(
        frame(
            schemas.RAW_SETLISTS,
            [{"setlist_id": "s", "event_date": "01-01-2020", "song_count": 2, "tour_name": "T"}],
        )
    )
    unified = staging.concerts_unified(events, setlists)
    expected = frame(schemas.CONCERTS_UNIFIED, []).schema
    assert [(f.name, f.dataType) for f in unified.schema] == [(f.name, f.dataType) for f in expected]
    got = {r["concert_id"]: r for r in dicts(unified)}
    assert got["e"]["source"] == "ticketmaster" and got["e"]["setlist_id"] is None
    assert got["s"]["source"] == "setlistfm" and got["s"]["songs_played_count"] == 2
    assert got["s"]["tour_id"] == "T" and got["s"]["event_status"] is None


def test_checkpoint_view_takes_every_status_and_only_name_matches(frame):
    view = staging.concerts_checkpoint_view(
        frame(schemas.RAW_EVENTS, [event("a", event_status="cancelled", artist_mbid="own"), event("b", "X")]),
        frame(schemas.RAW_ARTISTS, [artist("m1", at=T1), artist("m2", at=T2)]),
        T3,
    )
    got = {r["concert_id"]: r for r in dicts(view)}
    assert got["a"]["artist_mbid"] == "m2" and got["a"]["event_status"] == "cancelled"
    assert got["b"]["artist_mbid"] is None and got["b"]["ingested_at"] == T3
    assert got["a"]["ticket_price_min_gbp"] is None
