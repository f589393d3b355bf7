import datetime as dt
import json

import pytest
from conftest import dicts

from tourlens import schemas
from tourlens.operators.matching import count_by_reason
from tourlens.sources import landing


def attraction(name="Muse", total=3, kind=None):
    made = {"name": name, "classifications": [{"type": {"name": kind}, "genre": {"name": "Rock"}, "subGenre": {"name": ""}}]}
    return made if total is None else made | {"upcomingEvents": {"_total": total}}


def event(event_id, attractions=None, status="onsale", venue="Arena", country="GB", day="2024-06-01"):
    inside = {"venues": [{"id": "v", "name": venue, "city": {"name": "L"}, "country": {"countryCode": country}}]}
    if attractions != "absent":
        inside["attractions"] = [attraction()] if attractions is None else attractions
    dates = {"start": {"localDate": day, "dateTime": f"{day}T19:00:00Z"}}
    if status != "absent":
        dates["status"] = {"code": status}
    return {"id": event_id, "name": "n", "dates": dates, "_embedded": inside}


@pytest.fixture
def pages(spark, tmp_path):
    def make(*events_per_page):
        folder = tmp_path / f"p{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        for i, events in enumerate(events_per_page):
            page = {"country_order": 0, "chunk": 0, "page": i, "_embedded": {"events": events}}
            (folder / f"{i}.json").write_text(json.dumps(page))
        (folder / "empty.json").write_text(json.dumps({"country_order": 0, "chunk": 0, "page": 9}))
        return landing.read_event_pages(spark, str(folder))

    return make


def test_filters(pages):
    judged = landing.judged_events(
        pages(
            [
                event("none", []),
                event("absent", "absent"),
                event("two", [attraction(total=2)]),
                event("three"),
                event("unknown", [attraction(total=None)]),
                event("style", [attraction(kind="Event Style")]),
                event("kindless", [attraction(kind=None)]),
                event("off", status="cancelled"),
                event("quiet", status="absent"),
                event("inn", [attraction("Holiday Inn")], venue="Holiday Inn Resort"),
                event("museum", [attraction("Muse")], venue="Museum Hall"),
                event("u2", [attraction("U2")], venue="U2 Arena"),
                event("nowhere", venue=None),
                event("", None),
                event(None, None),
            ]
        )
    )
    got = {r["event_id"]: r["reject_reason"] for r in dicts(judged) if r["event_id"]}
    assert got == {
        "none": "no_attraction",
        "absent": "no_attraction",
        "two": "few_upcoming",
        "three": None,
        "unknown": "few_upcoming",
        "style": "not_an_artist",
        "kindless": None,
        "off": "called_off",
        "quiet": None,
        "inn": "venue_as_artist",
        "museum": "venue_as_artist",
        "u2": None,
        "nowhere": None,
    }
    assert {r["outcome"]: r["n"] for r in dicts(count_by_reason(judged))}["no_id"] == 2


def test_the_first_listing_wins(pages):
    first = event("e", [attraction("First (US Tour)")])
    got = dicts(
        landing.flatten_events(
            pages([event("e", [attraction(total=1)])], [event("x"), first], [event("e", [attraction("Second")])])
        )
    )
    assert {r["event_id"]: r["artist_name"] for r in got} == {"x": "Muse", "e": "First"}
    row = next(r for r in got if r["event_id"] == "e")
    assert row["tm_genre"] == "Rock" and row["tm_subgenre"] is None
    assert row["event_datetime_utc"] == dt.datetime(2024, 6, 1, 19)
    assert row["artist_mbid"] is None and row["venue_name"] == "Arena"


def test_raw_schema(pages, frame):
    got = landing.flatten_events(pages([event("e")])).schema
    want = frame(schemas.RAW_EVENTS, []).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want]


def test_window_and_market(pages):
    listed = pages([event("now"), event("late", day="2026-01-01"), event("far", country="JP"), event("undated", day=None)])
    judged = landing.judged_events(listed, as_of=dt.date(2024, 1, 1), countries=["GB", "US"])
    assert {r["event_id"]: r["reject_reason"] for r in dicts(judged)} == {
        "now": None,
        "late": "outside_window",
        "far": "other_market",
        "undated": "outside_window",
    }


def setlist(setlist_id, sets=None, date="31-12-2020", **more):
    made = {"id": setlist_id, "eventDate": date, "artist": {"mbid": "m", "name": "Muse"}, "versionId": "1"}
    made |= {"venue": {"name": "Arena", "city": {"name": "L", "country": {"code": "GB", "name": "UK"}}}}
    return made | ({"sets": sets} if sets is not None else {}) | more


def flattened(spark, tmp_path, *pages):
    for i, page in enumerate(pages):
        body = {"requested_artist": "Asked", "requested_mbid": "m", "setlist": page}
        (tmp_path / f"{i}.json").write_text(json.dumps(body))
    rows = landing.flatten_setlists(landing.read_setlist_pages(spark, str(tmp_path)))
    return {r["setlist_id"]: r for r in dicts(rows)}


def test_setlist_shapes(spark, tmp_path):
    a, b = {"name": "A "}, {"name": "B"}
    got = flattened(
        spark,
        tmp_path,
        setlist("lone", {"set": {"song": a}}),
        [
            setlist("object", {"set": {"song": [a, b]}}),
            setlist("list", {"set": [{"song": [a]}, {"encore": 1, "song": b}]}),
            setlist("gap", {"set": [{"song": []}, {"name": "no songs"}, {"song": [a, b]}]}),
            setlist("odd", {"set": {"song": [a, {"name": ""}, {"name": None}, {}, b]}}),
            setlist("blank", {"set": {"song": [{"name": "  "}]}}),
            setlist("empty", {"set": []}),
            setlist("bare"),
        ],
    )
    songs = {k: (v["song_count"], v["songs_played"]) for k, v in got.items()}
    assert songs == {
        "lone": (1, "A"),
        "object": (2, "A; B"),
        "list": (2, "A; B"),
        "gap": (2, "A; B"),
        "odd": (2, "A; B"),
        "blank": (1, ""),
        "empty": (0, None),
        "bare": (0, None),
    }
    assert got["lone"]["country_code"] == "GB" and got["lone"]["setlistfm_version"] == "1"


def test_setlist_cutoff_and_fallbacks(spark, tmp_path):
    got = flattened(
        spark,
        tmp_path,
        [
            setlist("old", date="31-12-1999"),
            setlist("kept", date="01-01-2000"),
            setlist("undated", date=None),
            setlist("odd", date="TBA"),
            setlist("nameless", artist={"mbid": "m", "name": ""}),
            setlist("", date="01-01-2000"),
        ],
    )
    assert sorted(got) == ["kept", "nameless", "odd", "undated"]
    assert got["undated"]["event_date"] == "" and got["nameless"]["artist_name"] == "Asked"


def test_setlist_schema(spark, tmp_path, frame):
    (tmp_path / "0.json").write_text("{}")
    got = landing.flatten_setlists(landing.read_setlist_pages(spark, str(tmp_path)))
    want = frame(schemas.RAW_SETLISTS, []).schema
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want]
    assert got.count() == 0
