"""Properties of random small tables, against plain Python where that is short."""

import datetime as dt
import random

import pytest
from conftest import dicts

from tourlens import schemas
from tourlens.plans import marts, staging


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_setlist_marts(frame, seed):
    rng = random.Random(seed)
    artists = [("i%d" % i, rng.choice(["A", "B", None]), rng.choice(["rock", "pop", None])) for i in range(4)]
    facts = []
    for i in range(60):
        songs = "; ".join(rng.choice("abcde ") for _ in range(rng.randrange(5)))
        facts.append(
            {
                "concert_id": str(rng.randrange(50)),
                "artist_id": rng.choice(["i0", "i1", "i2", "i3", "gone", None]),
                "artist_name": rng.choice(["C", "D", None]),
                "event_date": rng.choice([None, dt.date(2000 + rng.randrange(4), 1, 1)]),
                "songs_played": rng.choice([None, songs, songs]),
                "source": rng.choice(["setlistfm", "setlistfm", "ticketmaster"]),
            }
        )
    fact = frame(schemas.FACT_CONCERT, facts)
    dim = frame(schemas.DIM_ARTIST, [{"artist_id": a, "mbid": a, "artist_name": n, "primary_genre": g} for a, n, g in artists])

    known = {a: (n, g and g.title()) for a, n, g in artists}
    concerts = []
    for f in facts:
        if f["source"] == "setlistfm" and f["event_date"]:
            name, genre = known.get(f["artist_id"], (None, None))
            songs = [s.strip() for s in (f["songs_played"] or "").split("; ") if s.strip()]
            name = f["artist_name"] if name is None else name
            concerts.append((name, genre, f["event_date"].year, f["concert_id"], songs))

    sung = [(n, g, y, s) for n, g, y, _, songs in concerts if n is not None for s in songs]
    want = {}
    for n, g, y in {r[:3] for r in sung}:
        mine = [r[3] for r in sung if r[:3] == (n, g, y)]
        for other in {c[1] for c in concerts if c[0] == n and c[2] == y}:
            counted = len({c[3] for c in concerts if c[:3] == (n, other, y)})
            key = (n, g, y, counted)
            unique, total = want.get(key, (len(set(mine)), 0))
            want[key] = (unique, total + len(mine))
    got = {
        (r["artist_name"], r["primary_genre"], r["concert_year"], r["concert_count"]): (r["unique_songs"], r["total_song_performances"])
        for r in dicts(marts.yearly_repertoire(fact, dim))
    }
    assert got == want

    rows = dicts(marts.setlist_freshness(fact, dim))
    assert {(r["artist_name"], r["primary_genre"], r["concert_year"]) for r in rows} == {r[:3] for r in sung}
    for r in rows:
        n, g, y = r["artist_name"], r["primary_genre"], r["concert_year"]
        songs = {x[3] for x in sung if x[:3] == (n, g, y)}
        new = {s for s in songs if y == min(x[2] for x in sung if x[0] == n and x[3] == s)}
        assert (r["unique_songs"], r["first_time_songs"], r["repeated_songs"]) == (len(songs), len(new), len(songs) - len(new))
        assert r["concert_count"] == len({c[3] for c in concerts if c[0] == n and c[2] == y})
        if y == min(x[2] for x in sung if x[0] == n):
            assert r["freshness_pct"] == 100.0


@pytest.mark.parametrize("seed", [4, 5])
def test_staged_events(frame, seed):
    """One event id holds a third of the rows, one name a third of the artists."""
    rng, day = random.Random(seed), dt.datetime(2024, 1, 1)
    artists = [
        {
            "mbid": f"m{i}",
            "artist_name": rng.choice(["Hot", " HOT "]) if i % 3 == 0 else rng.choice(["a", "B", "c", None]),
            "extracted_at": rng.choice([None, day, day + dt.timedelta(days=rng.randrange(3))]),
        }
        for i in range(30)
    ]
    events = [
        {
            "event_id": "hot" if i % 3 == 0 else f"e{rng.randrange(20)}",
            "artist_name": rng.choice(["hot", "A ", "b", "nobody", None]),
            "artist_mbid": rng.choice([None, None, None, f"own{i}"]),
            "event_date": "2024-06-01",
            "event_status": rng.choice([None, "onsale", "cancelled"]),
            "city": str(i),
            "extracted_at": day + dt.timedelta(minutes=i),
        }
        for i in range(120)
    ]

    def key(name):
        return None if name is None else name.strip().lower()

    def order(pair):
        event, artist = pair
        stamp = artist and artist["extracted_at"]
        return (
            event["artist_mbid"] is None,
            stamp is None,
            -(stamp or day).timestamp(),
            artist is None,
            artist["mbid"] if artist else "",
            -event["extracted_at"].timestamp(),
        )

    want = {}
    for event_id in {e["event_id"] for e in events}:
        pairs = []
        for e in events:
            if e["event_id"] == event_id and e["event_status"] != "cancelled":
                name = key(e["artist_name"])
                found = [a for a in artists if name is not None and key(a["artist_name"]) == name]
                pairs += [(e, a) for a in found or [None]]
        if pairs:
            event, artist = min(pairs, key=order)
            want[event_id] = (event["artist_mbid"] or (artist and artist["mbid"]), event["city"])

    staged = staging.stg_events(frame(schemas.RAW_EVENTS, events), frame(schemas.RAW_ARTISTS, artists))
    assert {r["concert_id"]: (r["artist_mbid"], r["city"]) for r in dicts(staged)} == want
