"""Repair of conversations against all paths, and the auction's prices."""

import random
from collections import defaultdict
from functools import cache

import brute

from tourlens.llm import conversations
from tourlens.llm.conversations import Lattice, _entries, _kind
from tourlens.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.01"
FAULTS = ["", "blank", "duplicate", "truncated"]
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def traced(kinds, block):
    """The audit of a conversation that is cut into blocks from its end."""
    parts = [kinds[max(0, end - block) : end] for end in range(len(kinds), 0, -block)]
    exits = [None]
    for part in parts[:-1]:
        exits.append(_entries(bytes(part), exits[-1]))
    state, audit = 0, ""
    for part, behind in zip(reversed(parts), reversed(exits), strict=True):
        lattice = Lattice(bytes(part), behind)
        node, edits = state, lattice.trace(state)
        for edit in edits:
            node = next(to for e, _, to in lattice.arcs(node) if e == edit)
        state, audit = node % 4, audit + edits
    return audit


def test_cheapest_and_least_audits():
    rng = random.Random(12)
    for _ in range(600):
        rows = [(rng.choice("suaauu x"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.choice([1, 2, 3, 6, 12, 40]))]
        expected = brute.cheapest([(i, FAULTS[f]) for i, f in rows])[1]
        kinds = [_kind(i, f) for i, f in rows]
        for block in (1, 2, 5, 64):
            assert traced(kinds, block) == expected


def test_settled_prices_are_distances():
    rng = random.Random(13)
    for _ in range(50):
        lattice = Lattice(bytes(_kind(rng.choice("sua"), rng.choice([0, 1, 3])) for _ in range(10)), None)

        @cache
        def distance(node, inserts=0):
            if node == lattice.end:
                return 0
            ways = [cost + distance(to, (inserts + 1) * (edit == "I")) for edit, cost, to in lattice.arcs(node) if edit != "I" or inserts < 3]
            return min(ways, default=1 << 60)

        for node in range(4):
            assert lattice.settle(node) == distance(node)
        assert all(price <= distance(node) for node, price in enumerate(lattice.price))


def expected_of(rows):
    groups = defaultdict(list)
    for conv, *row in brute.damaged(rows):
        groups[conv].append(tuple(row))
    return {conv: brute.repaired(groups.get(conv, [])) for conv in {r[0] for r in rows}}


def query_over(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as conv", "'y' as fault", "'z' as copy")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got}, len(got)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{GIVEN}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_conversation_repair"](spark, GIVEN).collect()}
    assert got == expected_of(rows)


def test_nulls_ties_repeats_and_long_conversations(spark, tmp_path):
    rng = random.Random(14)
    rows = [(1, None, "user", "Hi."), (1, None, None, None), (2, 5, "user", "Hi."), (2, 5, "user", "Hi."), (None, 1, "assistant", "x"), (None, None, None, None)]
    rows += [(3, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["a.", "b", "", "c!", " \n", "d?\t"])) for t in range(300)]
    rows += [(4, t // 3, "user", "a.") for t in range(50)] + [(5, t, "user" if t % 2 == 0 else "assistant", f"{t}." * 1000) for t in range(100)]
    rows += [(6, 2**62, "user", "a."), (6, -5, "system", "b.")]
    got, n = query_over(spark, tmp_path, rows)
    assert n == len(got) and got == expected_of(rows)


def test_all_rows_dropped_and_empty_table(spark, tmp_path):
    from zlib import crc32

    dropped = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    got, _ = query_over(spark, tmp_path / "a", [(dropped, 0, "user", "a.")])
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", brute.sha(""))}
    got, _ = query_over(spark, tmp_path / "b", [])
    assert got == {}


def test_edits_are_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A"), (1, 2, "assistant", " ")]
    edits = conversations.repairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(e.step, e.edit, e.role, e.text) for e in edits] == [(0, "K", "system", "S."), (1, "I", "user", ""), (2, "K", "assistant", "A"), (3, "D", None, None)]
    assert [e.fault for e in edits] == ["", None, "truncated", "blank"]
