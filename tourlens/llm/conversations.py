"""Cheapest repair of the order of speakers in conversations, by an auction for shortest paths.

The lattice of a conversation has a node for each (row, state): the state is the role written last. Arcs are the edits: Delete (3),
Insert of an empty user or assistant row (2), Keep (0), Rerole (2); a kept truncated row costs 1 more. Paths end where the roles
read `(s?(ua)+)?`.

Auction: nodes have prices, at first equal to the least price at the end. From an origin a path is extended along the arc with the
least cost + price of its end, as long as the price of the path's last node does not lie below that; otherwise that price rises to it and the path
contracts by a node. When the path reaches the end, the origin's price is its exact distance. Prices
only rise and never pass the distance, so what has converged stays. Tracing goes from the origin along arcs that are tight
(price = cost + price of the end); the end of a tight arc gets an auction of its own, and only an arc still tight then lies on a
cheapest path. Of these the one whose initial is the least in ASCII is taken, which gives the least audit.

Rows of a conversation meet in one task, sorted by Spark, and stream through it: a backward pass settles the exact prices at the
borders of blocks of BLOCK rows, a forward pass traces block by block. Memory does not grow with a conversation (its audit, one string, excepted).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a lattice that is solved at once.
BLOCK = 16
DELETE, INSERT, RELABEL, TRUNCATED = 3, 2, 2, 1
#: States by the role written last; from each one role of user and assistant may follow.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = {"s": 0, "u": 1, "a": 2}
_FAULTS = ("", "blank", "duplicate", "truncated")
_BLANKS = " \t\n\x0b\x0c\r"


def _kind(initial: str, fault: int) -> int:
    """What the lattice knows of a row: its initial (3: another) and whether it must go or costs more."""
    return _INITIALS.get(initial, 3) + (16 if fault in (1, 2) else 4 * (fault == 3))


def _edits(kind: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edit, cost, rows passed and next state, in the order of the initials."""
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
    if kind < 16:
        more, role = TRUNCATED * (kind >= 4), kind % 4
        if role == 0 and state == BEGIN:
            arcs.append(("K", more, 1, SYSTEM))
        elif role == (2 if state == USER else 1):
            arcs.append(("K", more, 1, _NEXT[state]))
        arcs.append(("R", RELABEL + more, 1, _NEXT[state]))
    return arcs


_EDITS = {(kind, state): _edits(kind, state) for kind in (*range(8), *range(16, 20)) for state in range(4)}


class Lattice:
    """Rows of a block; `exits` are the prices of the states behind it, None at the end of the conversation."""

    def __init__(self, kinds: bytes, exits: tuple[int, ...] | None):
        self.kinds, self.exits = kinds, exits
        self.end = 4 * (len(kinds) + 1)
        self.price = [min(exits) if exits else 0] * (self.end + 1)
        if exits:
            self.price[4 * len(kinds) : self.end] = exits

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Edit, cost and end of the arcs that leave a node."""
        row, state = divmod(node, 4)
        if row < len(self.kinds):
            return [(edit, cost, node - state + 4 * rows + to) for edit, cost, rows, to in _EDITS[self.kinds[row], state]]
        return [("", 0, self.end)] * (state in (BEGIN, ASSISTANT)) + [("I", INSERT, node - state + _NEXT[state])]

    def final(self, node: int) -> bool:
        return node == self.end or (self.exits is not None and node >= 4 * len(self.kinds))

    def settle(self, origin: int) -> int:
        """The auction: after it the origin's price is its distance to the end."""
        price, path = self.price, [origin]
        while not self.final(path[-1]):
            least, to = min((cost + price[to], to) for _, cost, to in self.arcs(path[-1]))
            if price[path[-1]] < least:
                price[path[-1]] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def trace(self, state: int) -> str:
        """The least string of edits on a cheapest path from a state before the first row."""
        node, edits = state, ""
        self.settle(node)
        while not self.final(node):
            for edit, cost, to in self.arcs(node):
                if cost + self.price[to] == self.price[node] and cost + self.settle(to) == self.price[node]:
                    edits, node = edits + edit, to
                    break
        return edits


@lru_cache(1 << 16)
def _traced(kinds: bytes, exits: tuple[int, ...] | None, state: int) -> str:
    return Lattice(kinds, exits).trace(state)


@lru_cache(1 << 12)
def _entries(kinds: bytes, exits: tuple[int, ...] | None) -> tuple[int, ...]:
    """Prices of the four states before a block's first row, above the least of them: edits depend on differences only."""
    lattice = Lattice(kinds, exits)
    prices = [lattice.settle(state) for state in range(4)]
    return tuple(p - min(prices) for p in prices)


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last row of each conversation to its first: each row's block, from the end, and the prices behind it."""
    open_, kinds, exits, rows = object(), bytearray(), None, 0
    for batch in batches:
        blocks, behind = [], []
        for conv, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv", "initial", "fault")), strict=True):
            if conv != open_:
                open_, kinds, exits, rows = conv, bytearray(), None, 0
            elif rows % BLOCK == 0:
                exits, kinds = _entries(bytes(reversed(kinds)), exits), bytearray()
            blocks.append(rows // BLOCK)
            behind.append(exits)
            kinds.append(_kind(initial, fault))
            rows += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(blocks, pa.int64()), pa.array(behind, pa.list_(pa.int64()))], names=[*batch.schema.names, "block", "behind"]
        )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first row of each conversation to its last: a row per edit."""
    names = ("conv", "turn", "initial", "fault", "role", "text", "block", "behind")
    place, state, step, held = (object(), None), BEGIN, 0, []
    out: list[tuple] = []
    kind = None

    def traced() -> None:
        """The edits of the rows held, which are a block."""
        nonlocal state, step
        kinds = bytes(_kind(initial, fault) for _, _, initial, fault, *_ in held)
        behind = held[0][-1]
        row = 0
        for edit in _traced(kinds, None if behind is None else tuple(behind), state):
            if edit == "I":
                state = _NEXT[state]
                out.append((held[0][0], step, edit, None, None, None, _ROLE[state], ""))
            else:
                conv, turn, initial, fault, role, text, *_ = held[row]
                row += 1
                if edit == "R":
                    state = _NEXT[state]
                    role = _ROLE[state]
                elif edit == "K":
                    state = SYSTEM if state == BEGIN and initial == "s" else _NEXT[state]
                else:
                    role = text = None
                out.append((conv, step, edit, turn, initial, _FAULTS[fault], role, text))
            step += 1
        held.clear()

    def emitted() -> pa.RecordBatch:
        arrays = [pa.array(column, t) for column, t in zip(zip(*out, strict=True) if out else [()] * 8, kind, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["conv", "step", "edit", "turn", "initial", "fault", "role", "text"])

    for batch in batches:
        field = batch.schema.field
        kind = [field("conv").type, pa.int64(), pa.string(), field("turn").type, pa.string(), pa.string(), pa.string(), pa.string()]
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if (row[0], row[6]) != place:
                if held:
                    traced()
                if row[0] != place[0]:
                    state, step = BEGIN, 0
                place = (row[0], row[6])
            held.append(row)
        yield emitted()
    if held:
        traced()
        yield emitted()


def repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per edit of the cheapest repair: conv, step, edit (D, I, K, R), turn, initial and fault of the row as it came, role and text after it.

    The frame stays sorted by conv and step within its partitions, a conversation in one. Deleted rows have null role and text, inserted ones
    null turn, initial and fault. A fault is blank, duplicate (role and text seen earlier in the conversation), truncated
    (does not end in . ! or ?) or empty.

    Defined cases: rows are taken by turn, nulls first, then role and text; null roles and texts are one space; a null id is a
    conversation of its own; repeated rows are duplicates; other columns are not read; an empty table gives an empty result.
    """
    rows = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).repartition("conv")
    same = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    bare = F.rtrim("text", F.lit(_BLANKS))
    fault = F.when(bare == "", 1).when(F.col("copy") > 1, 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    rows = rows.withColumn("copy", F.row_number().over(same)).select("*", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    listed = ", ".join(f"`{n}` {t}" for n, t in kinds.items())
    priced = rows.sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("copy")).mapInArrow(
        _priced, f"{listed}, block long, behind array<long>"
    )
    forward = priced.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "copy")
    return forward.mapInArrow(
        _edited, f"conv {kinds['conv']}, step long, edit string, turn {kinds['turn']}, initial string, fault string, role string, text string"
    )


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the edits of conversations in order to a row per conversation."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    costs = {"D": DELETE, "I": INSERT, "K": 0, "R": RELABEL}
    now: dict | None = None
    done: list[tuple] = []
    kind = None

    def close() -> None:
        gaps = now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0
        faults = [now["faults"].get(f, 0) for f in _FAULTS[1:]]
        done.append((now["conv"], gaps, *faults, now["illegal"], now["cost"], "".join(now["audit"]), now["digest"].hexdigest()))

    def emitted() -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [()] * 9, [kind, *[pa.int64()] * 6, pa.string(), pa.string()], strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, edit, turn, initial, fault, role, text in zip(
            *(batch.column(c).to_pylist() for c in ("conv", "edit", "turn", "initial", "fault", "role", "text")), strict=True
        ):
            if now is None or conv != now["conv"]:
                if now is not None:
                    close()
                now = {"conv": conv, "first": None, "last": None, "turns": 0, "faults": {}, "illegal": 0, "initial": None, "cost": 0, "audit": [], "digest": hashlib.sha256(), "lines": 0}
            now["audit"].append(edit)
            now["cost"] += costs[edit] + TRUNCATED * (fault == "truncated" and edit != "D")
            if edit != "D":
                now["digest"].update(("\n" * (now["lines"] > 0) + role + ":" + text).encode())
                now["lines"] += 1
            if edit != "I":
                now["faults"][fault] = now["faults"].get(fault, 0) + 1
                now["illegal"] += now["initial"] is not None and now["initial"] + initial not in ("su", "ua", "au")
                now["initial"] = initial
                if turn is not None and turn != now["last"]:
                    now["first"] = turn if now["first"] is None else now["first"]
                    now["last"], now["turns"] = turn, now["turns"] + 1
        yield emitted()
    if now is not None:
        close()
        yield emitted()


def audits(edits: DataFrame) -> DataFrame:
    """A row per conversation of what `repairs` returns: conv, gaps, faults, illegal, cost, audit and the hash of the repaired rows."""
    kind = edits.schema["conv"].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return edits.mapInArrow(_audited, f"conv {kind}, {numbers}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of `conv_id:turn`: rows dropped, emptied, cut, repeated or given to the user."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    checksum = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(checksum == 1, "").when(checksum == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(checksum == 4, "user").otherwise(filled("role"))
    copies = F.when(checksum == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(checksum != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")
