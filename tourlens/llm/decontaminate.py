"""Benchmark decontamination by the q-gram lemma and banded alignment.

An occurrence of an item of m bytes with at most k edits shares at least m + 1 - q - k * q of the item's
q-grams with the text, and all of them lie within k diagonals (place in the text minus place in the item)
of each other. Shared q-grams are counted in bands of 2 w diagonals that start every w (w > k), so
that each such region lies whole in one band; bands that meet the bound are kept and verified by an alignment
of the item that stays inside the band. k is `rate` of the item's length, lowered where the bound would be empty.

The same lemma and alignment run over words, for partial and reworded quotes: an item is also contained where any
PASSAGE of its words in a row, or the whole of an item shorter than two passages, occurs with edits of at most
WORD_RATE of the words. Word q-grams are rarer than those of bytes, so q is small and the edit rate large.
Words are runs of letters, marks and digits; in scripts without spaces between words, bytes alone decide on parts of a sentence.

A q-gram at more than HEAVY places of an item is not counted: the bound falls by its places in the item. Where none is left of
the bound, as in an item that repeats one letter, texts with enough such q-grams are aligned as a whole. Shared
q-grams are counted MATCHES at a time, so repetitive texts need no more memory than others.

Texts and items are compared in lower case with white space as single spaces.
The items are the fixed query set, dealt to groups of at most `MOST_BYTES` (a longer item is a group of its own). Driver
and tasks hold the q-grams of one group at a time: each group is one pass over the documents, whose result is
written to the shared folder before the next group is read. A benchmark of one group is not written in between.
Documents are read in slices, one by one, with no shuffle.

Defined cases: null and empty texts contain nothing. Null or empty items are contained nowhere; items
shorter than q bytes match exactly and as whole words. Equal items are all reported. Repeated rows are looked at one by one;
null ids pass through. An empty table of documents gives an empty result, an empty benchmark none contaminated.
Columns of documents are kept by `decontaminated`; only id and text are read otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourlens.llm.common import bytes_and_offsets, slices, texts
from tourlens.sources import workspace

Q = 10
#: Edits allowed per byte of an item.
RATE = 0.08
#: Bytes of items that the driver or a task holds at once.
MOST_BYTES = 16 << 20

#: Words of a q-gram, words of a passage, and edits allowed per word.
WORD_Q, PASSAGE = 3, 25
WORD_RATE = 0.2

#: Places of a q-gram in an item that are counted; shared q-grams that are counted at once.
HEAVY, MATCHES = 64, 1 << 22

_TABLE_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def canonical(array: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.replace_substring_regex(array, r"[\x20\x09-\x0D]+", " "))


def _codes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q bytes at each place: two words of eight bytes that overlap."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    raw = np.ascontiguousarray(raw)
    low = np.ndarray((n,), "<u8", raw.data, 0, (1,))
    high = np.ndarray((n,), "<u8", raw.data, Q - 8, (1,))
    return (low * _FACTOR) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F) + (high >> np.uint64(29)))


def edit_budget(length: int, rate: float = RATE, q: int = Q) -> int:
    """The most edits that leave the lemma a bound of at least one shared q-gram."""
    return max(0, min(int(rate * length), (length - q) // q))


def words(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and where each text begins and ends."""
    spaced = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(array), r"[^\p{L}\p{M}\p{N}]+", " "), " ")
    split = pc.split_pattern(spaced, " ")
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(flat, "")  # a text without words is split into one empty word
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[offsets - offsets[0]]


def _expanded(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each first on, as many as its count."""
    return np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _counted(first: np.ndarray, count: np.ndarray, key_of) -> tuple[np.ndarray, np.ndarray]:
    """Bands and their numbers of shared q-grams, for hits whose matches are `count` numbers from `first` on.

    `key_of` gives the strip of matches, from the hits' and the matches' numbers; a band is a strip and the next one.
    """
    keys, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends, a = np.cumsum(count), 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + MATCHES, "right")))
        key = key_of(np.repeat(np.arange(a, b), count[a:b]), _expanded(first[a:b], count[a:b]))
        met, times = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        keys.append(met)
        sums.append(times)
        a = b
    met, back = np.unique(np.concatenate(keys), return_inverse=True)
    return met, np.bincount(back, np.concatenate(sums), len(met)).astype(np.int64)


def _without_heavy(codes: np.ndarray, item: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted codes: which to keep, the heavy ones, and how many places of each item are heavy."""
    order = np.lexsort((item, codes))
    new = np.ones(len(codes), bool)
    new[1:] = (np.diff(codes[order]) != 0) | (np.diff(item[order]) != 0)
    count = np.diff(np.flatnonzero(new), append=len(codes))
    heavy = np.unique(codes[order][new][count > HEAVY])
    light = ~np.isin(codes, heavy)
    return light, heavy, np.bincount(item[~light], minlength=items)


def anywhere(item: np.ndarray, text: np.ndarray, budget: int) -> bool:
    """Whether the item occurs in the text with at most `budget` edits."""
    high = len(text) - len(item) + budget
    return high >= -budget and aligned(item, text, -budget, high, budget)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> bool:
    """Whether the item occurs in the text with at most `budget` edits on diagonals low to high."""
    width = high - low + 1
    base = np.arange(width)
    shift = width + max(-low, 0)  # padded[shift + j] is text[j]; no byte equals the padding
    padded = np.full(shift + len(text) + len(item) + max(high, 0) + width + 2, -1, np.int32)
    padded[shift : shift + len(text)] = text
    valid = np.full(len(padded) + 1, 10**6)
    valid[shift : shift + len(text) + 1] = 0
    # cost[d]: edits of the item so far that end before the text's place (row + diagonal); the start is free
    at = shift + low
    cost = valid[at : at + width].copy()
    for row, byte in enumerate(item.tolist(), at):
        moved = cost + (padded[row : row + width] != byte)
        np.minimum(moved[:-1], cost[1:] + 1, out=moved[:-1])  # a byte of the item left out
        # bytes of the text put in: running minimum along the diagonals
        cost = np.minimum.accumulate(moved - base) + base
        np.maximum(cost, valid[row + 1 : row + 1 + width], out=cost)
        if cost.min() > budget:
            return False
    return bool(cost.min() <= budget)


@dataclass(frozen=True)
class Passages:
    """The word q-grams of the items, by code, with item and place."""

    vocabulary: pa.Array
    items: list[np.ndarray]  # places in the vocabulary, from 1
    own: list[np.ndarray]  # codes of each item by place
    codes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    heavy: np.ndarray
    spare: np.ndarray

    @classmethod
    def of(cls, contents: list[str]) -> Passages:
        flat, offsets = words(pa.array(contents, pa.large_string()))
        coded = flat.dictionary_encode()
        numbers = coded.indices.to_numpy().astype(np.int64) + 1
        at, item, codes = cls._grams(numbers, offsets)
        items = [numbers[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        own = np.split(codes, np.searchsorted(item, np.arange(1, len(items)))) if items else []
        order = np.argsort(codes, kind="stable")
        codes, item, place = codes[order], item[order], (at - offsets[item])[order]
        light, heavy, spare = _without_heavy(codes, item, len(items))
        return cls(coded.dictionary, items, own, codes[light], item[light], place[light], heavy, spare)

    @staticmethod
    def _grams(numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, texts and codes of the q-grams of known words that lie in one text."""
        n = max(len(numbers) - WORD_Q + 1, 0)
        known = np.ones(n, bool)
        for k in range(WORD_Q):
            known &= numbers[k : n + k] > 0
        at = np.flatnonzero(known)
        text = np.searchsorted(offsets, at, "right") - 1
        whole = at + WORD_Q <= offsets[text + 1]
        at, text = at[whole], text[whole]
        codes = np.zeros(len(at), np.uint64)
        for k in range(WORD_Q):
            codes = codes * _FACTOR + numbers[at + k].astype(np.uint64)
        return at, text, codes

    @staticmethod
    def parts(length: int) -> list[tuple[int, int, int]]:
        """Words, most edits and least q-grams of the kinds of passages of an item of so many words."""
        sizes = [length] * (length < 2 * PASSAGE) + [PASSAGE] * (length > PASSAGE)
        budgets = [edit_budget(n, WORD_RATE, WORD_Q) for n in sizes]
        return [(n, k, n + 1 - WORD_Q * (k + 1)) for n, k in zip(sizes, budgets, strict=True)]

    def found(self, array: pa.Array) -> list[set[int]]:
        """For each text, the items of which it has a passage."""
        out: list[set[int]] = [set() for _ in range(len(array))]
        flat, offsets = words(array)
        numbers = pc.fill_null(pc.index_in(flat, self.vocabulary), -1).to_numpy().astype(np.int64) + 1
        at, doc, codes = self._grams(numbers, offsets)
        everywhere = np.zeros(len(numbers) + 1, np.uint64)  # codes by place; a word of an item is no zero
        everywhere[at] = codes
        lengths = np.array([len(i) for i in self.items] or [0])
        kinds = {n: self.parts(n) for n in set(lengths.tolist())}
        # Passages of an item share its bands, which are as wide as the largest budget of any asks.
        most = np.array([max((k for _, k, _ in kinds[n]), default=0) for n in lengths.tolist()])
        least = np.array([min((need for _, _, need in kinds[n]), default=1) for n in lengths.tolist()])
        common = (least - self.spare < 1) & (self.spare > 0) if len(self.items) else np.zeros(1, bool)
        is_heavy = np.isin(codes, self.heavy)
        for i in np.flatnonzero(common).tolist():
            enough = np.bincount(doc[is_heavy | np.isin(codes, self.own[i])], minlength=len(array)) >= least[i]
            for d in np.flatnonzero(enough).tolist():
                text = numbers[offsets[d] : offsets[d + 1]]
                for n, budget, _ in kinds[int(lengths[i])]:
                    if any(anywhere(self.items[i][a : a + n], text, budget) for a in range(lengths[i] - n + 1)):
                        out[d].add(i)
                        break
        first = np.searchsorted(self.codes, codes, "left")
        count = np.searchsorted(self.codes, codes, "right") - first
        at, doc, first, count = (x[count > 0] for x in (at, doc, first, count))
        if not len(at):
            return out
        low = -int(lengths.max()) - 1
        bands = int(np.diff(offsets).max()) - low + 2

        def strip(hit: np.ndarray, which: np.ndarray) -> np.ndarray:
            item = self.item[which]
            band = np.floor_divide(at[hit] - offsets[doc[hit]] - self.place[which], most[item] + 1)
            return (doc[hit] * len(lengths) + item) * bands + band - low

        met, sums = _counted(first, count, strip)
        for one in met[sums >= (least - self.spare)[met // bands % len(lengths)]].tolist():
            d, i, b = one // bands // len(lengths), one // bands % len(lengths), one % bands + low
            if i in out[d] or common[i]:
                continue
            k, own = int(most[i]), self.own[i]
            held = np.isin(own, self.heavy)
            for diagonal in range(b * (k + 1), (b + 2) * (k + 1)):
                a, z = max(0, -diagonal), min(len(own), int(offsets[d + 1] - offsets[d]) - diagonal)
                if a < z:
                    begin = offsets[d] + diagonal
                    held[a:z] |= own[a:z] == everywhere[begin + a : begin + z]
            held = np.concatenate([[0], np.cumsum(held)])
            for n, budget, need in kinds[int(lengths[i])]:
                for begin in np.flatnonzero(held[n - WORD_Q + 1 : lengths[i] - WORD_Q + 2] - held[: lengths[i] - n + 1] >= need).tolist():
                    start, last = begin + b * (k + 1) - k, begin + (b + 2) * (k + 1) - 1 + k
                    from_ = max(start, 0)
                    window = numbers[offsets[d] + from_ : min(offsets[d] + max(last + n + 1, 0), offsets[d + 1])]
                    if aligned(self.items[i][begin : begin + n], window, start - from_, last - from_, budget):
                        out[d].add(i)
                        break
                if i in out[d]:
                    break
        return out


@dataclass(frozen=True)
class Items:
    """The q-grams of the items, by code, with item and place; short items as they are."""

    names: list[list]
    texts: list[bytes]
    rate: float
    codes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    heavy: np.ndarray
    spare: np.ndarray
    table: np.ndarray
    passages: Passages

    @classmethod
    def of(cls, rows: list[tuple], rate: float = RATE) -> Items:
        rows = [(name, text) for name, text in rows if text and text.strip()]
        stripped = pc.utf8_trim_whitespace(canonical(pa.array([t for _, t in rows], pa.large_string()))).to_pylist()
        names: dict[str, list] = {}
        for (name, _), text in zip(rows, stripped, strict=True):
            names.setdefault(text, []).append(name)
        contents = [t.encode() for t in names]
        codes, item, place = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, content in enumerate(contents):
            own = _codes(np.frombuffer(content, np.uint8))
            codes.append(own)
            item.append(np.full(len(own), i))
            place.append(np.arange(len(own)))
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(flat >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        flat, item, place = flat[order], np.concatenate(item)[order], np.concatenate(place)[order]
        light, heavy, spare = _without_heavy(flat, item, len(contents))
        return cls(list(names.values()), contents, rate, flat[light], item[light], place[light], heavy, spare, table, Passages.of(list(names)))

    def contained(self, array: pa.Array) -> list[list]:
        """For each text, the names of the items it contains, whole or by a passage."""
        both = zip(self.found(array), self.passages.found(array), strict=True)
        return [[name for i in sorted(whole.keys() | part) for name in self.names[i]] for whole, part in both]

    def found(self, array: pa.Array) -> list[dict[int, int]]:
        """For each text, the items it contains whole and the place (byte of the canonical text) of one occurrence."""
        out: list[dict[int, int]] = [{} for _ in range(len(array))]
        raw, offsets = bytes_and_offsets(canonical(array))
        for i, content in enumerate(self.texts):
            if len(content) < Q:
                self._short(i, content, raw, offsets, out)
        codes = _codes(raw)
        at = np.flatnonzero(self.table[(codes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        doc = np.searchsorted(offsets, at, "right") - 1
        whole = at + Q <= offsets[doc + 1]  # q-grams across two texts are none
        at, doc = at[whole], doc[whole]
        length = np.array([len(c) for c in self.texts] or [0])
        budget = np.array([edit_budget(n, self.rate) for n in length.tolist()])
        need = length + 1 - Q - budget * Q
        common = (need - self.spare < 1) & (self.spare > 0) if self.texts else np.zeros(1, bool)
        if common.any():
            heavy = np.bincount(doc[np.isin(codes[at], self.heavy)], minlength=len(array))
            for i in np.flatnonzero(common).tolist():
                light = length[i] + 1 - Q - self.spare[i]
                for d in np.flatnonzero(heavy + light >= need[i]).tolist():
                    text, content, k = raw[offsets[d] : offsets[d + 1]], self.texts[i], int(budget[i])
                    if heavy[d] and (text.tobytes().find(content) >= 0 or anywhere(np.frombuffer(content, np.uint8), text, k)):
                        out[d][i] = 0
        first = np.searchsorted(self.codes, codes[at], "left")
        count = np.searchsorted(self.codes, codes[at], "right") - first
        at, first, count, doc = at[count > 0], first[count > 0], count[count > 0], doc[count > 0]
        # A band holds two strips; its count is the number of shared q-grams in either.
        low = -int(length.max()) - 1
        bands = int(np.diff(offsets).max(initial=0)) - low + 2

        def strip(hit: np.ndarray, which: np.ndarray) -> np.ndarray:
            item = self.item[which]
            band = np.floor_divide(at[hit] - offsets[doc[hit]] - self.place[which], budget[item] + 1)
            return (doc[hit] * len(length) + item) * bands + band - low

        met, sums = _counted(first, count, strip)
        for one in met[sums >= (need - self.spare)[met // bands % len(length)]].tolist() if self.texts else []:
            d, i, b = one // bands // len(length), one // bands % len(length), one % bands + low
            if i in out[d] or common[i]:
                continue
            k = int(budget[i])
            start, last = b * (k + 1) - k, (b + 2) * (k + 1) - 1 + k
            content, begin = self.texts[i], max(start, 0)
            window = raw[offsets[d] + begin : min(offsets[d] + max(last + len(content) + 1, 0), offsets[d + 1])]
            exact = window.tobytes().find(content) >= 0
            if exact or aligned(np.frombuffer(content, np.uint8), window, start - begin, last - begin, k):
                out[d][i] = begin
        return out

    def _short(self, i: int, content: bytes, raw: np.ndarray, offsets: np.ndarray, out: list[dict[int, int]]) -> None:
        everything, at = raw.tobytes(), -1
        while (at := everything.find(content, at + 1)) >= 0:
            d = int(np.searchsorted(offsets, at, "right")) - 1
            end = at + len(content)
            begins = at == offsets[d] or everything[at - 1 : at] == b" "
            ends = end == offsets[d + 1] or everything[end : end + 1] == b" "
            if end <= offsets[d + 1] and begins and ends:
                out[d].setdefault(i, int(at - offsets[d]))


def _groups(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items in groups of at most MOST_BYTES, each for one pass over the documents."""
    group, size = [], 0
    rows = benchmark.select(key, text).where(F.col(text).isNotNull()).orderBy(key, text)
    for name, content in rows.toLocalIterator():
        more = len(content.encode())
        if group and size + more > MOST_BYTES:
            yield group
            group, size = [], 0
        group.append((name, content))
        size += more
    yield group


def _in_passes(docs: DataFrame, groups: Iterator[list[tuple]], rate: float, one: Callable[[DataFrame, Broadcast, bool], DataFrame]) -> DataFrame:
    """`one` applied to the documents with each group's items in turn; all results but the last are written first."""
    spark, group, before = docs.sparkSession, next(groups), None
    while True:
        shared = spark.sparkContext.broadcast(Items.of(group, rate))
        group = next(groups, None)
        docs = one(docs, shared, group is None)
        if group is None:
            return docs
        path = workspace.new_folder(spark, "decontamination-pass")
        docs = workspace.settled(docs, path)
        shared.destroy()
        if before:
            workspace.delete(spark, before)
        before = path


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", rate: float = RATE
) -> DataFrame:
    """A row per row: id, contaminated, items (ids of the items it contains, ascending), n_items."""
    kind = benchmark.schema[item].dataType.simpleString()
    arrow = pa.int64() if kind in ("bigint", "int", "smallint", "tinyint") else pa.string()
    kind = "bigint" if arrow == pa.int64() else "string"
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.array().cast(f"array<{kind}>").alias("items"))

    def one(rows: DataFrame, shared: Broadcast, last: bool) -> DataFrame:
        def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    found = items.contained(texts(part, "text"))
                    names = [[*own, *new] for own, new in zip(part.column("items").to_pylist(), found, strict=True)]
                    names = pa.array([sorted(x for x in own if x is not None) for own in names], pa.list_(arrow))
                    seen = pa.nulls(part.num_rows, part.schema.field("text").type) if last else part.column("text")
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), seen, names], names=["doc_id", "text", "items"])

        return rows.mapInArrow(looked, rows.schema)

    rows = _in_passes(rows, _groups(benchmark, item, item_text), rate, one)
    return rows.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", F.size("items").alias("n_items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """The documents that contain no item, all columns as they came."""
    schema = T.StructType(docs.schema.fields)

    def one(docs: DataFrame, shared: Broadcast, last: bool) -> DataFrame:
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    yield part.filter(pa.array([not x for x in shared.value.contained(texts(part, text))], pa.bool_()))

        return docs.mapInArrow(kept, schema)

    return _in_passes(docs, _groups(benchmark, item, item_text), rate, one)
