"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words whose smallest period q fits at least TIMES times, and LEAST words at least, that no
neighbouring word extends keeping period q.

1. Periods up to SMALL are found directly: stretches of words that equal the word q places on.
2. For each scale t = 4, 8, 16, ... the synchronising set holds the places where the hash of the window of t words is
   the least of t + 1 neighbouring windows, at their first or last place. Membership depends on the 2 t words from the place
   on only, so equal contexts are members alike. Windows inside a run of a period up to t / 4, already
   known from a lower scale, do not count: the set stays sparse in highly periodic regions.
3. A run of period q, t <= q < 2 t, holds a member among its first t places, and the next place with the same context is
   exactly q further on. So neighbours in the order (context, place) that are t to 2 t apart propose their distance as a
   period; chains of such pairs are joined, checked word by word and extended to both sides as far as the period holds.

Words are compared by numbers given to equal words of a slice of texts, contexts by hashes of 64 bits whose pairs are checked.
Tasks hold one slice of texts at a time, and a longer text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import slices, texts
from tourlens.llm.shingles import mixed

#: A run has LEAST words and TIMES periods at least. The method needs TIMES >= 4.
LEAST, TIMES = 6, 4
#: Periods that are found directly; the first scale is the next power of two.
SMALL = 3
#: Bytes of text that are searched together.
TOGETHER = 1 << 18
_NONE = np.uint64(2**64 - 1)


def _direct(words: np.ndarray, q: int) -> np.ndarray:
    """Rows start, length, period of all maximal stretches of period q and TIMES * q words."""
    same = np.zeros(max(len(words) - q, 0) + 2, np.int8)
    same[1:-1] = words[:-q] == words[q:]
    edges = np.flatnonzero(np.diff(same))
    start, length = edges[::2], edges[1::2] - edges[::2] + q
    long = length >= TIMES * q
    return np.stack([start[long], length[long], np.full(long.sum(), q)], axis=1)


def _synchronising(windows: np.ndarray, t: int, known: np.ndarray) -> np.ndarray:
    """Places whose window of t words, or the one t places on, has the least hash of the t + 1 windows between."""
    hashes = windows
    small = known[(4 * known[:, 2] <= t) & (known[:, 1] >= t)]
    if len(small):
        inside = np.zeros(len(windows) + 1, np.int32)
        np.add.at(inside, small[:, 0], 1)
        np.add.at(inside, small[:, 0] + small[:, 1] - t + 1, -1)
        hashes = np.where(np.cumsum(inside[:-1]) > 0, _NONE, windows)
    least, step = hashes, 1
    while step < t:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:-1], hashes[t:])
    first, last = hashes[: len(least)], hashes[t : t + len(least)]
    return np.flatnonzero(((least == first) | (least == last)) & (least != _NONE))


def _reach(words: np.ndarray, at: np.ndarray, step: int, period: np.ndarray, block: int = 64) -> np.ndarray:
    """For how many places, from `at` on in steps of 1 or -1, a word equals the one a period further on."""
    out, active = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(active):
        places = (at[active] + step * out[active])[:, None] + step * np.arange(block)
        other = places + period[active][:, None]
        inside = (places >= 0) & (other < len(words))
        same = inside & (words[np.where(inside, places, 0)] == words[np.where(inside, other, 0)])
        reach = np.where(same.all(axis=1), block, same.argmin(axis=1))
        out[active] += reach
        active = active[reach == block]
    return out


def _proposed(words: np.ndarray, places: np.ndarray, contexts: np.ndarray, t: int) -> np.ndarray:
    """Runs of periods t to 2 t - 1 from members of the synchronising set with equal contexts of 2 t words."""
    order = np.argsort(contexts, kind="stable")
    places, contexts = places[order], contexts[order]
    period = np.diff(places)
    pair = (contexts[1:] == contexts[:-1]) & (period >= t) & (period < 2 * t)
    place, period = places[:-1][pair], period[pair]
    if not len(place):
        return np.empty((0, 3), np.int64)
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    # Of one period and overlapping by a period: parts of one stretch.
    opens = np.ones(len(place), bool)
    opens[1:] = (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 2 * t)
    first, period = place[opens], period[opens]
    last = place[np.append(np.flatnonzero(opens)[1:], len(place)) - 1] + 2 * t  # the last compared place, exclusive
    lengths = last - first
    at = np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    true = np.logical_and.reduceat(words[at] == words[at + np.repeat(period, lengths)], np.cumsum(lengths) - lengths)
    first, last, period = first[true], last[true], period[true]
    start = first - _reach(words, first - 1, -1, period)
    end = last + _reach(words, last, 1, period) + period
    found = np.stack([start, end - start, period], axis=1)
    return found[found[:, 1] >= TIMES * period]


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows start, length, period of all runs, by start, then period, in numbered words; separators are numbers used once.

    `longest` is the length of the longest text.
    """
    known = np.concatenate([_direct(words, q) for q in range(1, SMALL + 1)])
    # A stretch of period 1 is one of period 2 and 3 too; the smallest period counts.
    known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
    again = np.zeros(len(known), bool)
    again[1:] = (known[1:, :2] == known[:-1, :2]).all(axis=1)
    known = known[~again]
    with np.errstate(over="ignore"):
        windows, t = mixed(words.astype(np.uint64)), 1
        while TIMES * t <= longest:
            contexts = mixed(windows[:-t] * np.uint64(0xD6E8FEB86659FD93) + windows[t:])
            if t > SMALL:
                places = _synchronising(windows, t, known)
                known = np.concatenate([known, _proposed(words, places, contexts[places], t)])
            windows, t = contexts, 2 * t
    known = known[known[:, 1] >= LEAST]
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row: the key, n_words, runs (array of start, length, period by start, then period) and collapsed.

    Words are runs without ASCII white space, numbered from 0. Collapsed is the text's words, joined by one space, without those that
    any run contains after its first period.

    Defined cases: null and empty texts have no words, no runs and an empty collapsed text. Rows are treated alone: repeated ids, null
    ids and ties do not matter. Only the key and the text are read; an empty table gives an empty result.
    """
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                split = [t.split() for t in texts(part, "text").cast(pa.large_binary()).to_pylist()]
                n = np.array([len(w) for w in split], np.int64)
                flat = [w for words in split for w in words]
                begin = np.cumsum(n) - n
                numbers: dict[bytes, int] = {}
                words = np.full(len(flat) + len(split), -1, np.int64)
                word = np.arange(len(flat)) + np.repeat(np.arange(len(split)), n)
                words[word] = np.fromiter(map(numbers.setdefault, flat, count()), np.int64, len(flat))
                words[begin + n + np.arange(len(split))] = -1 - np.arange(len(split))
                found = runs_of(words, int(n.max()))
                first = begin + np.arange(len(split))
                doc = np.searchsorted(first, found[:, 0], "right") - 1
                depth = np.zeros(len(words) + 1, np.int32)
                np.add.at(depth, found[:, 0] + found[:, 2], 1)
                np.add.at(depth, found[:, 0] + found[:, 1], -1)
                keep = np.cumsum(depth[:-1])[word] == 0
                collapsed = []
                for a, b, own in zip(begin.tolist(), (begin + n).tolist(), split, strict=True):
                    inside = keep[a:b]
                    collapsed.append(b" ".join(own if inside.all() else compress(own, inside.tolist())))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(split)))])
                fields = [pa.array(x) for x in (found[:, 0] - first[doc], found[:, 1], found[:, 2])]
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(run)))
                columns = [part.column("key"), pa.array(n), listed, pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "runs", "collapsed"])

    kind = kept.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return kept.mapInArrow(searched, schema).withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """Of an array of runs the one with the greatest length / period, then the first; null if there is none."""

    def better(a: Column, b: Column) -> Column:
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def looped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and texts in which one of ten ids repeats its words from one on, with a period that its checksum chooses."""
    checksum = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.expr(rf"filter(split(`{text}`, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    rows = docs.select(F.col(key), F.col(text), F.when(checksum % 10 == 0, words).alias("_words"))
    n = F.size("_words")
    g = F.floor(checksum / 10)
    start = F.pmod(g, F.greatest(n, F.lit(1)))
    period = 1 + F.expr("(_n - _a) div (3 + _g % 8)")
    rows = rows.withColumns({"_n": n, "_g": g, "_a": start}).withColumn("_p", period)
    repeated = F.expr("array_join(transform(sequence(0, _n - 1), i -> _words[cast(if(i < _a, i, _a + (i - _a) % _p) as int)]), ' ')")
    return rows.select(key, F.when(F.col("_n") > 0, repeated).otherwise(F.col(text)).alias(text))
