"""Language identification by prediction by partial matching.

Each language has a variable-order tree of byte contexts with counts from labelled texts. A byte
that its longest seen context has not met escapes to the next shorter one (escape estimate C: a
context with D different bytes among T escapes with D / (T + D)), down to a uniform order below
the shortest. Statistics are frozen after training, so a byte's code length given a context is a
constant; a tree keeps the contexts and bytes that its language's sample met, as sorted codes by order, so
its size follows the sample and the order is the same for any alphabet and number of languages. A text's code
length under a language is the sum over its bytes, exact, each distinct context and byte of a slice looked up once.

Texts are lower-cased and every run of non-letters becomes one space, so markup and numbers do not
vote. Training takes whole labelled texts, at most `per_language` of each language by the order of
a digest of their ids (the documented bound on the sample); scoring takes every whole text. Labels are counted first, so that only
about twice the sample's texts are shuffled, however many tasks read the table.

The score is the best language's share among the languages. Where even its tree needs more than the eight bits a byte of no model at
all, as in a script that no language of the sample has, the score falls in proportion.

Defined cases: a null text or one without letters is `und` with score 0. Null labels are not learned.
No labelled rows: everything is `und`. Ties go to the first language by code point. Rows are scored one
by one, so repeated rows and null ids are as good as others. Extra columns are carried by
`identify`, which replaces existing columns of the result's names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tourlens.llm.common import bytes_and_offsets, drawn, fold, part, slices, texts

UNDETERMINED = "und"
#: Labelled texts of a language that are learned at most.
PER_LANGUAGE = 400
#: Longest context in bytes.
ORDER = 3
#: Bits of a byte without any model.
UNMODELLED = 8.0
#: Rows whose id has this remainder are held out.
FOLDS, HELD_OUT = 5, 0


def _prepared(array: pa.Array, order: int) -> pa.Array:
    """Letters only, lower case, words between single spaces, led by as many spaces as a context has."""
    words = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(array), r"[^\p{L}]+", " "), " ")
    pad, end = pa.scalar(" " * order, pa.large_string()), pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(pad, words, end, pa.scalar("", pa.large_string()))


def _grams(raw: np.ndarray, order: int) -> np.ndarray:
    """The code of the `order + 1` bytes from each place: a context and the byte after it."""
    assert order <= 3, "contexts are coded in four bytes"
    n = max(len(raw) - order, 0)
    codes = np.zeros(n, np.uint32)
    for k in range(order + 1):
        codes = (codes << np.uint32(8)) | raw[k : n + k].astype(np.uint32)
    return codes


def _found(codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted are among the sorted codes, and the places of those."""
    at = np.searchsorted(codes, wanted)
    there = at < len(codes)
    there[there] = codes[at[there]] == wanted[there]
    return there, at[there]


@dataclass(frozen=True)
class Level:
    """What a language met at one length of context: sorted codes with their code lengths in bits."""

    grams: np.ndarray  # a context and the byte after it
    hit: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass(frozen=True)
class ContextTrees:
    """Frozen trees of all languages: levels by length of context, shortest first."""

    languages: list[str]
    order: int
    trees: list[list[Level]]

    @classmethod
    def fitted(cls, counted: dict[str, dict[bytes, int]], order: int) -> ContextTrees:
        """From counts of `order + 1` bytes by language: a context and the byte after it."""
        languages = sorted(counted)
        trees = []
        for language in languages:
            grams = counted[language]
            codes = _grams(np.frombuffer(b"".join(grams), np.uint8), order)[:: order + 1]
            times = np.fromiter(grams.values(), float, len(grams))
            levels = []
            for length in range(order + 1):
                own, which = np.unique(codes & np.uint32((1 << 8 * (length + 1)) - 1), return_inverse=True)
                here = np.bincount(which, times, len(own))
                contexts, which = np.unique(own >> np.uint32(8), return_inverse=True)
                kinds = np.bincount(which, minlength=len(contexts))
                whole = np.log2(np.bincount(which, here, len(contexts)) + kinds)
                levels.append(Level(own, whole[which] - np.log2(here), contexts, whole - np.log2(kinds)))
            trees.append(levels)
        return cls(languages, order, trees)

    def _costs(self, levels: list[Level], grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after the bytes before it."""
        cost = np.zeros(len(grams))
        left = np.arange(len(grams))
        for length in range(self.order, -1, -1):
            level, wanted = levels[length], grams[left] & np.uint32((1 << 8 * (length + 1)) - 1)
            hit, at = _found(level.grams, wanted)
            cost[left[hit]] += level.hit[at]
            left, wanted = left[~hit], wanted[~hit]
            escapes, at = _found(level.contexts, wanted >> np.uint32(8))
            cost[left[escapes]] += level.escape[at]
        cost[left] += 8.0
        return cost

    def code_lengths(self, array: pa.Array) -> np.ndarray:
        """Bits of each prepared text under each language."""
        return self._coded(array)[0]

    def _coded(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each prepared text under each language, and its bytes."""
        raw, offsets = bytes_and_offsets(_prepared(array, self.order))
        coded = pa.array(_grams(raw, self.order)).dictionary_encode()
        grams, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        out = np.empty((len(array), len(self.languages)))
        # The last `order` positions of a text would reach into the next one: sums end before them.
        starts, ends = offsets[:-1], offsets[1:] - self.order
        bounds = np.stack([starts, ends], axis=1).reshape(-1)
        for j, levels in enumerate(self.trees):
            cost = np.append(self._costs(levels, grams)[which], 0.0)
            out[:, j] = np.add.reduceat(cost, np.minimum(bounds, len(cost) - 1))[::2] if len(array) else 0
        return out, np.maximum(ends - starts, 1)

    def predictions(self, array: pa.Array) -> tuple[pa.Array, pa.Array]:
        has_letter = pc.match_substring_regex(array, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        if not self.languages or not len(array):
            return pa.array([UNDETERMINED] * len(array), pa.string()), pa.array([0.0] * len(array))
        bits, size = self._coded(array)
        best, least = bits.argmin(axis=1), bits.min(axis=1)
        share = 1 / np.exp2(np.minimum(least[:, None] - bits, 0)).sum(axis=1)
        share *= np.minimum(UNMODELLED * size / np.maximum(least, 1e-9), 1)
        names = np.array(self.languages, object)[best]
        names[~has_letter] = UNDETERMINED
        return pa.array(names, pa.string()), pa.array(np.where(has_letter, share, 0.0))


def labelled_sample(docs: DataFrame, key: str, text: str, label: str, per_language: int) -> DataFrame:
    """Learned texts: label and text, a bounded number of each label outside the held-out fold."""
    rows = docs.where(fold(F.col(key), FOLDS) != HELD_OUT).where(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    counts = rows.groupBy("label").count().collect()  # one row of each language
    if counts:
        parts = F.create_map(*[F.lit(x) for r in counts for x in (r["label"], part(per_language, r["count"]))])
        rows = rows.where(drawn(F.col("id")) <= F.element_at(parts, F.col("label")))
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "text")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language).select("label", "text")


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    per_language: int = PER_LANGUAGE,
    order: int = ORDER,
) -> ContextTrees:
    """Trees from the labelled sample; contexts are counted in the tasks and summed by Spark."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                labels = np.array(part.column("label").to_pylist(), object)
                for name in dict.fromkeys(labels):
                    array = texts(part, "text").filter(pa.array(labels == name))
                    raw, offsets = bytes_and_offsets(_prepared(array, order))
                    inside = np.ones(len(raw), bool)
                    for back in range(1, order + 1):
                        inside[np.maximum(offsets[1:] - back, 0)] = False
                    at = _grams(raw, order)
                    grams, n = np.unique(at[inside[: len(at)]], return_counts=True)
                    yield pa.record_batch(
                        {"label": pa.array([name] * len(grams), pa.string()), "gram": grams.astype(np.int64), "n": n}
                    )

    sample = labelled_sample(docs, key, text, label, per_language)
    counts = sample.mapInArrow(contexts, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n"))
    # Bounded by the sample: languages times the contexts of per_language texts.
    found: dict[str, dict[bytes, int]] = {}
    for name, gram, n in counts.collect():
        found.setdefault(name, {})[gram.to_bytes(4, "big")[3 - order :]] = n
    return ContextTrees.fitted(found, order)


def identify(docs: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `score`."""
    rest = docs.drop("lang_pred", "score")
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text):
                name, score = model.predictions(texts(part, text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, name, score], names=[*part.schema.names, "lang_pred", "score"]
                )

    return rest.mapInArrow(scored, schema)


def keep_identified(docs: DataFrame, trees: ContextTrees, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents whose language is determined with at least this score, all columns as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text):
                name, score = model.predictions(texts(part, text))
                keep = pc.and_(pc.not_equal(name, UNDETERMINED), pc.greater_equal(score, least))
                yield part.filter(keep)

    return docs.mapInArrow(kept, docs.schema)
