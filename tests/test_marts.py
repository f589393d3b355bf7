import datetime as dt

import pytest
from conftest import dicts

from tourlens import schemas
from tourlens.plans import boards, marts

AS_OF = dt.date(2024, 1, 1)


def listed(concert_id, artist="m", day=AS_OF, country="GB", **more):
    base = {"concert_id": concert_id, "artist_id": artist, "artist_name": "raw", "event_date": day}
    return base | {"event_month": day and day.replace(day=1), "country": country, "source": "ticketmaster"} | more


def played(concert_id, year, songs, artist="m", **more):
    base = listed(concert_id, artist, dt.date(year, 5, 5)) | {"songs_played": songs, "source": "setlistfm"}
    return base | more


@pytest.fixture
def tables(frame):
    def make(facts, artists=(("m", "Muse", "hip-hop"),)):
        dim = [{"artist_id": i, "mbid": i, "artist_name": n, "primary_genre": g} for i, n, g in artists]
        return frame(schemas.FACT_CONCERT, facts), frame(schemas.DIM_ARTIST, dim)

    return make


def test_touring_intensity(tables):
    fact, dim = tables(
        [
            listed("1"),
            listed("2", day=dt.date(2024, 9, 1)),
            listed("3", country="US"),
            listed("past", day=dt.date(2023, 12, 31)),
            listed("same month, past", day=dt.date(2023, 12, 1)),
            listed("unlinked", None),
            listed("nameless", artist_name=None),
            listed("unknown", "x"),
            played("4", 2024, "A"),
        ]
    )
    got = {(r["artist_name"], r["primary_genre"], r["country"]): r["concert_count"] for r in dicts(marts.touring_intensity(fact, dim, AS_OF))}
    assert got == {("Muse", "Hip-Hop", "GB"): 2, ("Muse", "Hip-Hop", "US"): 1, ("raw", None, "GB"): 1}


def repertoire(fact, dim):
    return sorted(
        ((r["artist_name"], r["primary_genre"], r["concert_year"], r["concert_count"], r["unique_songs"], r["total_song_performances"])
        for r in dicts(marts.yearly_repertoire(fact, dim))), key=str
    )


def test_songs_are_trimmed_case_sensitive_and_never_empty(tables):
    assert repertoire(*tables([played("1", 2020, "One; ONE; One ; ; ")])) == [("Muse", "Hip-Hop", 2020, 1, 2, 3)]


def test_concerts_without_songs_count_but_make_no_year(tables):
    fact, dim = tables([played("1", 2020, "A"), played("2", 2020, None), played("3", 2021, None), played("1", 2020, "B")])
    assert repertoire(fact, dim) == [("Muse", "Hip-Hop", 2020, 2, 2, 2)]
    fresh = dicts(marts.setlist_freshness(fact, dim))
    assert [(r["concert_year"], r["concert_count"], r["unique_songs"]) for r in fresh] == [(2020, 2, 2)]


def test_names_fall_back_and_null_names_vanish(tables):
    fact, dim = tables([played("1", 2020, "A", None), played("2", 2020, "A", None, artist_name=None)])
    assert repertoire(fact, dim) == [("raw", None, 2020, 1, 1, 1)]
    assert [r["artist_name"] for r in dicts(marts.setlist_freshness(fact, dim))] == ["raw"]


TWINS = (("r", "Twin", "rock"), ("p", "Twin", "pop"))


def test_two_genres_of_one_name_multiply_rows(tables):
    # Counts of 2 and 1: each genre's songs meet both.
    fact, dim = tables([played("1", 2020, "A; B", "r"), played("2", 2020, "A", "r"), played("3", 2020, "C", "p")], TWINS)
    assert repertoire(fact, dim) == [
        ("Twin", "Pop", 2020, 1, 1, 1),
        ("Twin", "Pop", 2020, 2, 1, 1),
        ("Twin", "Rock", 2020, 1, 2, 3),
        ("Twin", "Rock", 2020, 2, 2, 3),
    ]


def test_equal_counts_of_two_genres_add_up(tables):
    fact, dim = tables([played("1", 2020, "A; B", "r"), played("3", 2020, "C", "p")], TWINS)
    assert repertoire(fact, dim) == [("Twin", "Pop", 2020, 1, 1, 2), ("Twin", "Rock", 2020, 1, 2, 4)]


def freshness(fact, dim):
    return {r["concert_year"]: r for r in dicts(marts.setlist_freshness(fact, dim))}


def test_freshness(tables):
    fact, dim = tables([played("1", 2019, "Old"), played("2", 2021, "Old; New"), played("3", 2021, "Old")])
    got = freshness(fact, dim)
    assert (got[2019]["freshness_pct"], got[2021]["freshness_pct"]) == (100.0, 50.0)
    assert (got[2021]["first_time_songs"], got[2021]["repeated_songs"], got[2021]["concert_count"]) == (1, 1, 2)


@pytest.mark.parametrize("fresh, of, share", [(1, 3, 33.3), (2, 3, 66.7), (1, 16, 6.3)])
def test_freshness_rounds_half_up(tables, fresh, of, share):
    before = [f"s{i}" for i in range(of - fresh)]
    after = before + [f"n{i}" for i in range(fresh)]
    fact, dim = tables([played("1", 2019, "; ".join(before)), played("2", 2020, "; ".join(after))])
    assert freshness(fact, dim)[2020]["freshness_pct"] == share


# --- boards -------------------------------------------------------------------


def test_touring_boards(frame):
    rows = [("A", "Rock", "GB", 5), ("A", "Rock", "US", 4), ("B", None, "GB", 7), ("C", "Pop", "GB", 7), ("D", "Pop", "DE", 1)]
    touring = frame(
        schemas.TOURING_INTENSITY,
        [dict(zip(("artist_name", "primary_genre", "country", "concert_count"), r)) for r in rows],
    )
    top = [(r.artist_name, r.concert_count) for r in boards.top_artists(touring, 2).collect()]
    assert top == [("A", 9), ("B", 7)]
    split = {(r.artist_name, r.country): r.concert_count for r in boards.top_artists_by_country(touring, 2).collect()}
    assert split == {("A", "GB"): 5, ("A", "US"): 4, ("B", "GB"): 7}
    assert [(r[0], r[1]) for r in boards.top_genres(touring).collect()] == [("Rock", 9), ("Pop", 8)]
    assert [r.artist_name for r in boards.top_touring_rows(touring, 3).collect()] == ["B", "C", "A"]


def test_evolution_skips_the_first_busy_year(frame):
    years = [(2018, 3), (2019, 6), (2020, 8)]
    rows = [{"artist_name": "A", "primary_genre": "Rock", "concert_year": y, "concert_count": n, "unique_songs": n, "total_song_performances": 10 * n, "first_time_songs": 1, "repeated_songs": n - 1, "freshness_pct": 50.0} for y, n in years]
    repertoire, fresh = frame(schemas.YEARLY_REPERTOIRE, rows), frame(schemas.SETLIST_FRESHNESS, rows)
    shown = [(r.concert_year, r.freshness_pct) for r in boards.artist_evolution(repertoire, fresh, "A").collect()]
    assert shown == [(2019, None), (2020, 50.0)]
    totals = boards.artist_totals(repertoire, "A").first()
    assert (totals.primary_genre, totals.total_years, totals.total_unique, totals.total_performances) == ("Rock", 2, 14, 140)
    assert [r[0] for r in boards.all_artists(repertoire, fresh).collect()] == ["A"]
    assert boards.evolution_snapshot(fresh).count() == fresh.where("artist_name is not null").count()


def test_date_range(frame):
    fact = frame(schemas.FACT_CONCERT, [listed("1", day=dt.date(2024, 2, 3)), listed("2", day=dt.date(2024, 11, 5)), listed("3", day=dt.date(2020, 1, 1))])
    shown = boards.date_caption(boards.upcoming_date_range(fact, AS_OF)).first()
    assert (shown.min_date, shown.max_date) == ("03/02/2024", "05/11/2024")


def test_setlist_marts_are_made_from_one_table(tables):
    """For a reader of both marts, concerts and songs are made once; the rows are those of each mart by itself."""
    fact, dim = tables(
        [played("1", 2020, "A; B; A"), played("2", 2021, "B; C"), played("3", 2021, "C", "n"), played("4", 2022, " ; ", None)],
        (("m", "Muse", "hip-hop"), ("n", "Muse", "rock")),
    )
    both = marts.setlist_marts(fact, dim)
    for got, want in zip(both, (marts.yearly_repertoire(fact, dim), marts.setlist_freshness(fact, dim))):
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "artist_id" not in text and "performances-" in text
