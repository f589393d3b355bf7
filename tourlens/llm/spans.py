"""Spans of pattern matches as column expressions: native, row by row, positions in code points.

Built-in functions give a pattern's matches and the text between them; their lengths add up to positions. Both
find matches the same way: leftmost, not overlapping, each search starting at the end of the match before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,rank:int,start:int,end:int,value:string>>"


def hits(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(numbers: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of an array: in parts of about the root of its size, then over the parts.

    Adding to an array copies it, so one pass over all would take the square of the matches of a text.
    """
    none = F.array().cast("array<int>")

    def sums(part: Column) -> Column:
        def add(done: Column, x: Column) -> Column:
            at = done["at"] + x
            return F.struct(at.alias("at"), F.concat(done["out"], F.array(at)).alias("out"))

        return F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda done: done["out"])

    def cut(all_: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_))).cast("int")
        return let(size, lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / n).cast("int")), lambda i: sums(F.slice(all_, i * n + 1, n))))

    def joined(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(F.zip_with(parts, ends, lambda p, end: let(end - F.element_at(p, -1), lambda more: F.transform(p, lambda x: x + more))))

    return let(numbers, lambda all_: F.when(F.size(all_) > 0, let(cut(all_), joined)).otherwise(none))


def located(text: Column, matches: Column, pattern: str, kind: str, rank: int) -> Column:
    """The matches (of `hits`, so none is searched twice) with their places; texts without any cost nothing."""

    def span(m: Column, end: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")
        )

    def spans(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        ends = running(F.zip_with(found, between, lambda m, g: F.length(m) + F.length(g)))
        return F.when(F.size(found) > 0, F.zip_with(found, ends, span)).otherwise(F.array().cast(SPANS))

    return let(matches, spans)


def apart(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of the taken ones."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def ordered(spans: Column) -> Column:
    """By start, then by rank of the kind."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))
    return F.array_sort(keyed)


def listed(spans: Column) -> Column:
    """kind:start:end, by start and kind, joined by commas."""
    return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
