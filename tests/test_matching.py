import datetime as dt

from conftest import dicts
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.operators import matching


def tags(*votes):
    return [{"name": n, "count": c} for n, c in votes]


def n_tags(n):
    return tags(*[(f"t{i}", 1) for i in range(n)])


def found(name, rank_id="id", tag_count=0, **more):
    return {"id": rank_id, "name": name, "tags": n_tags(tag_count)} | more


def match(frame, searches):
    rows = [{"searched_name": s, "artists": found_list} for s, found_list in searches]
    full = [
        r | {"artists": r["artists"] and [_whole(a) for a in r["artists"]]} for r in rows
    ]
    got = dicts(matching.match_searches(frame(schemas.ARTIST_SEARCH, full)))
    return {r["searched_name"]: r["match"] and r["match"]["name"] for r in got}


def _whole(a):
    names = ("id", "name", "country", "type", "disambiguation", "life-span", "tags")
    return {n: a.get(n) for n in names}


def test_matching_rules(frame):
    got = match(
        frame,
        [
            ("J. Cole", [found("Nat King Cole"), found("J Cole")]),
            ("Michael Jackson - Legacy", [found("Michael Jackson")]),
            ("Skye", [found("Skye Edwards"), found("Skyeward")]),
            ("Muse (US Tour)", [found("Museum"), found("The Muse")]),
            ("Sixth", [found(x) for x in "abcde"] + [found("Sixth")]),
            ("坂本", [found("坂本")]),
            ("Nobody", []),
            ("Nothing", None),
            ("Nameless", [found(None), found("Nameless")]),
        ],
    )
    assert got == {
        "J. Cole": "J Cole",
        "Michael Jackson - Legacy": None,
        "Skye": "Skye Edwards",
        "Muse (US Tour)": "The Muse",
        "Sixth": "Sixth",
        "坂本": None,
        "Nobody": None,
        "Nothing": None,
        "Nameless": "Nameless",
    }


def test_shadows(frame):
    got = match(
        frame,
        [
            ("Australian Bee Gees", [found("Australian Bee Gees"), found("Bee Gees", tag_count=15)]),
            ("Sugar Ray", [found("Sugar Ray", tag_count=14), found("Sugar", tag_count=6)]),
            ("Freya Skye", [found("Freya Skye", tag_count=1), found("Skye", tag_count=4)]),
            ("Big Seven", [found("Big Seven", tag_count=7), found("Seven", tag_count=10)]),
            ("Big Eight", [found("Big Eight", tag_count=8), found("Eight", tag_count=10)]),
            ("Great Abc", [found("Great Abc"), found("Abc", tag_count=50)]),
            ("Twin Name", [found("Twin Name"), found("Twin Name", tag_count=20)]),
        ],
    )
    assert got == {
        "Australian Bee Gees": None,
        "Sugar Ray": "Sugar Ray",
        "Freya Skye": "Freya Skye",
        "Big Seven": None,
        "Big Eight": "Big Eight",
        "Great Abc": "Great Abc",
        "Twin Name": None,
    }


def test_tags(spark, frame):
    df = frame(
        "i INT, tags ARRAY<STRUCT<name: STRING, count: BIGINT>>",
        [
            {"i": 0, "tags": tags(("rock", 5), ("indie", 5), ("pop", 2))},
            {"i": 1, "tags": []},
            {"i": 2, "tags": None},
            {"i": 3, "tags": tags(("a", None), ("b", 1), ("c", -1))},
        ],
    )
    got = [r.t for r in df.orderBy("i").select(matching.ranked_tags(F.col("tags")).alias("t")).collect()]
    assert got == [["rock", "indie", "pop"], [], None, ["b", "a", "c"]]


def resolve(frame, names, searches, cache=()):
    full = [
        {"searched_name": s, "artists": [_whole(a) for a in found_list]} for s, found_list in searches
    ]
    return matching.resolve_artists(
        frame("artist_name STRING, position INT", [{"artist_name": n, "position": i} for i, n in enumerate(names)]),
        frame(schemas.ARTIST_SEARCH, full),
        frame(schemas.ARTIST_RESOLUTION, list(cache)),
    )


def test_resolution_and_cache(frame):
    cache = [
        {"cache_key": "cached", "artist_name": "Cached", "mbid": "c", "mb_name": "Cached", "cache_version": 1},
        {"cache_key": "failed", "artist_name": "Failed", "cache_version": 1},
        {"cache_key": "stale", "artist_name": "Stale", "mbid": "old"},
    ]
    record = found("Stale", "new", type="Group", country="GB", **{"life-span": {"begin": "1998-05"}})
    record["tags"] = tags(("a", 1), ("b", 2))
    resolved = resolve(
        frame,
        [" CACHED ", "cached", "Failed", "Stale", "Found", "Unmatched", "Unsearched"],
        [
            ("cached", [found("Cached", "wrong")]),
            ("Failed", [found("Failed", "wrong")]),
            ("stale", [record]),
            ("Found", [found("Found", "f")]),
            ("Unmatched", [found("else", "e")]),
        ],
        cache,
    )
    got = {r["cache_key"]: r for r in dicts(resolved)}
    assert {k: v["mbid"] for k, v in got.items()} == {
        "cached": "c",
        "failed": None,
        "stale": "new",
        "found": "f",
        "unmatched": None,
    }
    stale = got["stale"]
    assert stale["artist_name"] == "Stale" and stale["formation_year"] == 1998
    assert stale["primary_genre"] == "b" and stale["genres"] == ["b", "a"]
    assert (stale["artist_type"], stale["origin_country"], stale["mb_name"]) == ("Group", "GB", "Stale")
    assert got["unmatched"]["genres"] == [] and got["unmatched"]["mb_name"] is None
    assert sorted(r["cache_key"] for r in dicts(matching.new_cache_entries(resolved))) == ["found", "stale", "unmatched"]
    assert {r["cache_version"] for r in dicts(resolved) if r["is_new"]} == {matching.CACHE_VERSION}


def test_a_cache_of_an_older_shape_is_stale(frame):
    old = frame("cache_key STRING, mbid STRING", [{"cache_key": "a", "mbid": "old"}])
    names = frame("artist_name STRING", [{"artist_name": "A"}])
    searches = frame(schemas.ARTIST_SEARCH, [{"searched_name": "A", "artists": [_whole(found("A", "new"))]}])
    resolved = matching.resolve_artists(names, searches, old)
    assert [r["mbid"] for r in dicts(resolved)] == ["new"]


def test_verification(frame):
    rows = [
        ("ok", "m", "Group", None),
        ("untyped", "m", None, "rock band"),
        ("empty", "m", "", None),
        ("character", "m", "Character", None),
        ("tribute", "m", "Group", "Queen TRIBUTE band"),
        ("covers", "m", None, "covers project"),
        ("none", None, "Group", None),
        ("blank", "", "Group", None),
    ]
    df = frame(
        schemas.ARTIST_RESOLUTION,
        [{"cache_key": k, "mbid": m, "artist_type": t, "disambiguation": d} for k, m, t, d in rows],
    )
    judged = matching.verify_artists(df)
    assert {r["cache_key"]: r["reject_reason"] for r in dicts(judged)} == {
        "ok": None,
        "untyped": None,
        "empty": None,
        "character": "artist_type",
        "tribute": "tribute",
        "covers": "tribute",
        "none": "no_mbid",
        "blank": "no_mbid",
    }
    assert matching.verified(judged).count() == 3
    # Rejected artists with an id still become artist rows.
    assert matching.artist_rows(judged, F.lit(dt.datetime(2024, 1, 1))).count() == 6


def test_enrichment_and_skipping(frame):
    artists = frame(schemas.ARTIST_RESOLUTION, [{"cache_key": "muse", "mbid": "m"}, {"cache_key": "new", "mbid": "n"}])
    events = frame(
        schemas.RAW_EVENTS,
        [{"event_id": "1", "artist_name": " MUSE"}, {"event_id": "2", "artist_name": "x"}, {"event_id": "3"}],
    )
    got = dicts(matching.with_artist_id(events, artists))
    assert [(r["event_id"], r["artist_mbid"]) for r in got] == [("1", "m")]
    stored = frame(schemas.RAW_SETLISTS, [{"artist_mbid": "m"}, {"artist_mbid": None}, {"artist_mbid": "m"}])
    assert [r["mbid"] for r in dicts(matching.without_setlists(artists, stored))] == ["n"]


def test_searches_are_matched_before_they_are_shuffled(spark):
    """What is sorted and sent is a record, not all results of a search."""
    from tourlens.sources.tables import typed_empty

    result = "named_struct('id', 'x', 'name', concat('B', id % 2), 'tags', array(named_struct('name', 't', 'count', 1L)))"
    rows = spark.range(20).selectExpr("concat('b', id % 2, repeat(' ', int(id))) AS searched_name", f"array({result}) AS artists")
    searches = spark.createDataFrame([], schemas.ARTIST_SEARCH).unionByName(
        rows.select("searched_name", F.from_json(F.to_json("artists"), typed_empty(spark, schemas.ARTIST_SEARCH).schema["artists"].dataType).alias("artists"))
    )
    names = spark.createDataFrame([("b0",), ("b1",), ("b7",)], "artist_name STRING")
    got = matching.resolve_artists(names, searches, typed_empty(spark, schemas.ARTIST_RESOLUTION))
    assert sorted((r.artist_name, r.mbid, r.mb_name) for r in got.collect()) == [("b0", "x", "B0"), ("b1", "x", "B1")]
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line and "digest" in line]
    assert windows
    below = text[text.index(windows[0]) :].splitlines()
    assert "artists#" not in below[1].split("Project", 1)[-1].split("xxhash64", 1)[0]
