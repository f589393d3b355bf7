import datetime as dt
import json

import pandas as pd
import pytest
from conftest import dicts
from pyspark.sql import functions as F
from test_landing import attraction, event

from tourlens import schemas
from tourlens.plans import boards
from tourlens.streaming import live

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def update(event_id, minutes, **more):
    return {"event_id": event_id, "observed_at": at(minutes), "event_status": "onsale"} | more


UPDATES = schemas.LIVE_UPDATES.replace(", is_new BOOLEAN", "")


def test_first_seen_over_batches_and_a_restart(spark, frame, tmp_path):
    folder, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    entered = []

    def arrive(*updates):
        frame(UPDATES, list(updates)).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema(UPDATES).option("maxFilesPerTrigger", 1).parquet(folder)
        rows = live.first_seen(stream)
        query = rows.writeStream.format("parquet").option("path", log).option("checkpointLocation", state)
        with live.state_store(spark):
            query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        entered.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]))
        return {(r.event_id, r.observed_at): r.is_new for r in spark.read.parquet(log).collect()}

    arrive(update("e1", 1), update("e2", 2), update("e3", 3))
    assert set(run().values()) == {True}
    # e2 is known, also in the earlier of its copies; e4 comes twice, the earlier is new.
    arrive(update("e1", 9), update("e2", 8), update("e2", 0), update("e4", 7), update("e4", 5))
    got = run()
    assert {k for k, new in got.items() if new} == {("e1", at(1)), ("e2", at(2)), ("e3", at(3)), ("e4", at(5))}
    arrive(update("e3", 20), update("e5", 20))
    got = run()
    assert len(got) == 10
    assert {k for k, new in got.items() if new and k[1] == at(20)} == {("e5", at(20))}
    assert entered == [3, 1, 1]


def test_only_nominees_reach_the_stateful_operator(spark, frame, tmp_path):
    folder = str(tmp_path / "in")
    frame(UPDATES, [update("hot", i) for i in range(500)] + [update("e", 1)]).coalesce(1).write.parquet(folder)
    rows = live.first_seen(spark.readStream.schema(UPDATES).parquet(folder))
    with live.state_store(spark):
        query = rows.writeStream.format("memory").queryName("nominees").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("nominees")
    assert sorted(map(tuple, got.where("is_new").select("event_id", "observed_at").collect())) == [("e", at(1)), ("hot", at(0))]
    assert got.count() == 501
    plan = query._jsq.lastProgress() and query._jsq.explainInternal(False)
    stateful = plan[plan.index("TransformWithState") :]
    assert "nominee" in stateful[: stateful.index("Scan")] and "Union" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(share" in exchanges[0]


def test_a_table_grows_by_the_columns_that_batches_bring(spark, frame, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))

    def run(ddl, *updates, checkpoint=state):
        frame(ddl, list(updates)).coalesce(1).write.mode("overwrite").parquet(folder)
        live.append_to_table(spark.readStream.schema(ddl).parquet(folder), table, checkpoint, once=True).awaitTermination()
        return sorted(map(tuple, live.read_table(spark, table).collect()))

    assert live.read_table(spark, table).count() == 0
    assert run("event_id STRING, n INT", {"event_id": "a", "n": 1}) == [("a", 1)]
    assert run("event_id STRING, city STRING", {"event_id": "b", "city": "x"}) == [("a", 1, None), ("b", None, "x")]
    with pytest.raises(Exception, match="other types"):
        run("event_id STRING, n STRING", {"event_id": "c", "n": "1"})
    assert sorted(r.event_id for r in live.read_table(spark, table).collect()) == ["a", "b"]


def test_batch_form_spreads_one_hot_event(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 40)).alias("event_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") % 100).alias("observed_at"),
        F.col("id").cast("string").alias("event_status"),
    )
    new = live.flag_first_sightings(rows)
    assert new.count() == 500
    got = {r.event_id: r.observed_at for r in new.where("is_new").collect()}
    want = {r.event_id: r.first for r in rows.groupBy("event_id").agg(F.min("observed_at").alias("first")).collect()}
    assert got == want
    assert new.where("is_new").count() == len(want)


def test_batch_form_spreads_one_event_at_one_time(spark):
    rows = spark.range(20_000, numPartitions=3).select(
        F.lit("hot").alias("event_id"), F.lit(START).alias("observed_at"), F.format_string("n%05d", "id").alias("city")
    )
    new = live.flag_first_sightings(rows).where("is_new").collect()
    assert [(r.event_id, r.city) for r in new] == [("hot", "n00000")]


@pytest.fixture
def pages(spark, tmp_path):
    events = [
        event("kept"),
        event("kept"),
        event("quiet", status="absent"),
        event("off", status="postponed"),
        event("few", [attraction(total=1)]),
        event("style", [attraction(kind="Venue Based")]),
        event("none", []),
        event(""),
        # The stream neither cleans names nor looks for venues listed as artists.
        event("venue", [attraction("Arena (UK)")], venue="Arena (UK) Hall"),
        event("far", country="JP", day="2030-01-01"),
    ]
    folder = tmp_path / "pages"
    folder.mkdir()
    page = {"country_order": 0, "chunk": 0, "page": 0, "_embedded": {"events": events}}
    (folder / "0.json").write_text(json.dumps(page))
    return str(folder)


def test_payload(spark, pages):
    got = {r["event_id"]: r for r in dicts(live.live_payload(spark.read.schema(schemas.EVENT_PAGE).json(pages), observed_at=START))}
    assert sorted(got) == ["far", "kept", "quiet", "venue"]
    assert got["quiet"]["event_status"] == "unknown"
    assert got["venue"]["artist_name"] == "Arena (UK)"
    near = live.live_payload(spark.read.schema(schemas.EVENT_PAGE).json(pages), countries=["GB"], as_of=dt.date(2024, 1, 1))
    assert sorted({r["event_id"] for r in dicts(near)}) == ["kept", "quiet", "venue"]


def test_publish_and_consume(spark, pages, tmp_path):
    path = {n: str(tmp_path / n) for n in ("topic", "sent", "log", "done")}
    stream = spark.readStream.schema(schemas.EVENT_PAGE).json(pages)
    flagged = live.live_updates(stream, observed_at=dt.datetime(2024, 1, 1, 2, 3, 4, 5))
    live.publish(flagged, path["topic"], path["sent"], once=True).awaitTermination()
    (tmp_path / "topic" / "junk.txt").write_text('not json\n{"event_id": "no time"}\n')

    def consume():
        messages = live.read_messages(spark, path["topic"])
        live.consume(messages, path["log"], path["done"], once=True).awaitTermination()
        return live.read_log(spark, path["log"])

    log = consume()
    got = sorted((r.event_id, r.is_new) for r in log.collect())
    assert got == [("far", True), ("kept", False), ("kept", True), ("quiet", True), ("venue", True)]
    assert {(r.observed_at, r.observed_date) for r in log.collect()} == {
        (dt.datetime(2024, 1, 1, 2, 3, 4, 5), dt.date(2024, 1, 1))
    }
    # Nothing is written twice.
    assert consume().count() == 5
    metrics = boards.live_metrics(log).first()
    assert (metrics.events_tracked, metrics.new_listings) == (4, 4)
    assert [tuple(r) for r in boards.live_status_breakdown(log).collect()] == [("onsale", 3), ("unknown", 1)]
    assert boards.live_recent(log, 2).first().Observed == "02:03 01/01"


def test_running_query_stops_cleanly(spark, pages, tmp_path):
    stream = live.live_payload(spark.readStream.schema(schemas.EVENT_PAGE).json(pages))
    query = live.publish(stream, str(tmp_path / "topic"), str(tmp_path / "sent"))
    assert query.isActive
    live.stop(query)
    assert not query.isActive
    assert spark.read.text(str(tmp_path / "topic")).count() == 5


def test_log_schema_and_liveness(spark, frame, tmp_path):
    assert live.read_log(spark, str(tmp_path / "none")).count() == 0
    old = frame("event_id STRING, observed_at TIMESTAMP", [{"event_id": "a", "observed_at": START}])
    old.write.parquet(str(tmp_path / "old"))
    assert live.read_log(spark, str(tmp_path / "old")).first().is_new is None
    assert boards.is_live(old, at(5)).first().is_live is True
    assert boards.is_live(old, at(50)).first().is_live is False
    assert boards.is_live(old.limit(0), at(5)).first().is_live is False


def test_messages_name_their_source(spark, frame):
    row = live.as_messages(frame(UPDATES, [update("e", 1)])).first()
    assert row.key == "e" and json.loads(row.value)["observed_at"].startswith("2024-01-01T00:01:00.000000")


class _State:
    """A map state that counts the calls made to it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getMapState(self, *_):
        return self

    def containsKey(self, key):
        self.calls += 1
        return key in self.held

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


class _Clock:
    now = 0

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_calls_to_the_state_grow_with_buckets_and_not_with_ids():
    order = ["observed_at", "event_name"]
    columns = ["event_id", "event_name", "observed_at", "is_new"]

    def batch(rows):
        return pd.DataFrame(rows, columns=columns[:3]).astype({"observed_at": "datetime64[ns]"})

    def run(processor, clock, *chunks):
        out = pd.concat(list(processor.handleInputRows((0,), iter(chunks), clock)))
        return {(r.event_id, r.event_name): r.is_new for r in out.itertuples()}

    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    state, clock = _State(), _Clock()
    processor = live._processor(columns, order, 1000)
    processor.init(state)
    ids = [f"e{i}" for i in range(3000)]
    # In many chunks; one id comes in each of them, the earliest row of it in the last but one.
    chunks = [batch([(i, "x", early) for i in ids[a : a + 100]] + [("hot", f"n{a}", early if a == 2800 else late)]) for a in range(0, 3000, 100)]
    flags = run(processor, clock, *chunks)
    assert len(flags) == 3030 and all(flags[i, "x"] for i in ids)
    assert [k for k, new in flags.items() if k[0] == "hot" and new] == [("hot", "n2800")]
    assert state.calls <= 2 * 16
    # Seen ids stay seen until their own time is over, whatever else came into their bucket since; no id reads as the empty one.
    clock.now = 600
    assert run(processor, clock, batch([("e1", "x", late), (None, "a", early), ("", "b", late), *[(f"f{i}", "x", late) for i in range(200)]])) == {
        ("e1", "x"): False, (None, "a"): True, ("", "b"): False, **{(f"f{i}", "x"): True for i in range(200)}
    }
    clock.now = 1000
    assert run(processor, clock, batch([("e1", "x", late), ("f1", "x", late), ("", "x", late)])) == {("e1", "x"): True, ("f1", "x"): False, ("", "x"): False}
