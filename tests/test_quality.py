import datetime as dt

import pytest
from conftest import dicts

from tourlens import schemas
from tourlens.operators import quality

NOW = dt.datetime(2024, 6, 30)


def test_columns(frame):
    df = frame("id STRING, v STRING", [{"id": "a"}, {"id": "a"}, {"id": None}, {"id": None}, {"id": "b", "v": "x"}])
    assert quality.not_null(df, "id").count() == 2
    assert [(r.id, r.copies) for r in quality.unique(df, "id").collect()] == [("a", 2)]
    assert quality.accepted_values(df, "v", ["y"]).count() == 1
    assert quality.accepted_values(df, "v", ["x"]).count() == 0
    parent = frame("key STRING", [{"key": "b"}])
    assert [r.id for r in quality.relationship(df, "id", parent, "key").collect()] == ["a", "a"]


def test_dates_and_types(frame):
    days = [dt.date(2027, 6, 30), dt.date(2027, 7, 1), None]
    fact = frame(schemas.FACT_CONCERT, [{"event_date": d} for d in days])
    assert [r.event_date for r in quality.too_far_ahead(fact, NOW.date()).collect()] == days[1:2]
    dim = frame(schemas.DIM_ARTIST, [{"mbid": m} for m in "abc"])
    raw = frame(schemas.RAW_ARTISTS, [{"mbid": "a", "artist_type": "Character"}, {"mbid": "b", "artist_type": "Choir"}, {"mbid": "c"}])
    assert [r.mbid for r in quality.invalid_artist_types(dim, raw).collect()] == ["a"]
    events = frame(schemas.RAW_EVENTS, [{"event_date": d} for d in ("2024-06-30", "2024-07-01", "soon", None)])
    assert quality.future_rows(events, NOW.date()).first().invalid_rows == 1


def test_freshness(frame):
    ages = {"fresh": 2, "old": 4, "stale": 8}
    raw = {n: frame(schemas.RAW_EVENTS, [{"extracted_at": NOW - dt.timedelta(days=d)}]) for n, d in ages.items()}
    raw["empty"] = frame(schemas.RAW_EVENTS, [])
    got = {r["source_table"]: r["status"] for r in dicts(quality.freshness(raw, NOW))}
    assert got == {"fresh": "pass", "old": "warn", "stale": "error", "empty": "error"}


def test_gate_stops_at_the_first_violation(frame):
    good, bad = frame("a INT", []), frame("a INT", [{"a": 1}])
    quality.gate({"one": good})
    with pytest.raises(quality.CheckFailed, match="two"):
        quality.gate({"one": good, "two": bad, "three": bad})
    assert [tuple(r) for r in quality.report({"one": good, "two": bad}).collect()] == [("one", 0), ("two", 1)]


def test_rules_and_keys_of_a_table_in_one_scan(spark, frame, tmp_path):
    rows = [{"id": "a", "v": "x"}, {"id": "a"}, {"id": "a", "v": "x"}, {"id": None, "v": "x"}, {"id": None}, {"id": "b", "v": "y"}]
    frame("id STRING, v STRING", rows).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    declared = {"t": quality.Declared(df, ["id", "v"], ["id", "v"], {"v.y": quality.not_accepted("v", ["x"])}), "u": quality.Declared(df.limit(0), ["id"], ["id"]), "w": quality.Declared(df, ["id"])}
    counts = quality.counted(declared)
    assert dict(map(tuple, counts.collect())) == {"t.id.not_null": 2, "t.v.not_null": 2, "t.v.y": 1, "t.id.unique": 1, "t.v.unique": 1, "u.id.not_null": 0, "u.id.unique": 0, "w.id.not_null": 2}
    plan = quality.counted({"t": declared["t"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
