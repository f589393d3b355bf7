"""Quality scores by regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of transformed statistics (lengths, shares of character kinds,
repetition, line shapes). For each class, Spark sums the moments of its labelled vectors over all data;
from them come the class means and covariances, shrunk towards the pooled covariance and its
diagonal. A score is the logistic of the difference of the classes' Mahalanobis log-densities, computed
with cached Cholesky factors.

Defined cases: a null text counts as an empty one and gets a score like any other. Labels other than 0
and 1 and rows without a label are not learned; a document labelled several times counts each time. If
a class has no labelled rows, all scores are the other class's value, and 0.5 without any.
Rows that repeat an id are scored one by one; in training each of them meets each label of its id. Null ids
are scored and never learned. Only the id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import bytes_and_offsets, fold, slices, texts, written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Part of the pooled covariance, and of its diagonal, in a class covariance.
POOLED, DIAGONAL = 0.4, 0.05
#: Log-density differences are divided by this before the logistic: QDA is overconfident.
TEMPERATURE = 2.0

_KINDS = np.zeros(256, np.uint8)  # 0 others, 1 lower, 2 upper, 3 digit, 4 space, 5 newline, 6 stop, 7 symbol, 8 beyond ASCII
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[[32, 9, 11, 12, 13]], _KINDS[10] = 1, 2, 3, 4, 5
_KINDS[[ord(c) for c in ".,;:?'\"-()"]] = 6
_KINDS[[ord(c) for c in "!#$%&*|@<>{}[]=+~^_/\\`"]] = 7
_KINDS[128:] = 8

FEATURES = [
    "log_bytes", "log_words", "upper", "digit", "stop", "symbol", "beyond", "word_length", "long_words",
    "distinct_words", "distinct_lines", "line_words", "capital_words", "ended_words", "top_word", "distinct_characters",
    "repeated_words",
]


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(array: pa.Array) -> np.ndarray:
    """A vector for each text, transformed to be roughly even."""
    raw, offsets = bytes_and_offsets(array)
    size = np.diff(offsets)
    kind = _KINDS[raw]
    shares = [np.log((_sums(kind == k, offsets) + 0.5) / (size + 4.5)) for k in (2, 3, 6, 7, 8)]
    space = (kind == 4) | (kind == 5)
    first = ~space
    first[1:] &= space[:-1]
    edges = offsets[:-1][size > 0]
    first[edges] = ~space[edges]
    last = ~space
    last[:-1] &= space[1:]
    last[offsets[1:][size > 0] - 1] = ~space[offsets[1:][size > 0] - 1]
    words = _sums(first, offsets)
    length = np.flatnonzero(last) - np.flatnonzero(first) + 1
    long = np.zeros(len(raw), bool)
    long[np.flatnonzero(first)[length > 14]] = True
    ended = last & np.isin(raw, np.frombuffer(b".!?", np.uint8))
    lines = np.empty((len(array), 6))
    for i, text in enumerate(array.to_pylist()):
        own = [x for x in text.split("\n") if x.strip()]
        spelt = text.lower().split()
        counts = Counter(spelt)
        again = sum(map(eq, spelt, spelt[1:]))
        lines[i] = len(own), len(set(own)), len(counts), max(counts.values(), default=0), len(set(text)), again
    m = np.maximum(words, 1)
    columns = [
        np.log1p(size),
        np.log1p(words),
        *shares,
        np.log1p(_sums(~space, offsets) / m),
        np.log((_sums(long, offsets) + 0.5) / (m + 1)),
        (lines[:, 2] + 1) / (m + 1) * np.sqrt(m),
        np.log((lines[:, 1] + 1) / (lines[:, 0] + 1)),
        np.log1p(m / np.maximum(lines[:, 0], 1)),
        np.log((_sums(first & (kind == 2), offsets) + 0.5) / (m + 1)),
        np.log((_sums(ended, offsets) + 0.5) / (m + 1)),
        np.log((lines[:, 3] + 1) / (m + 1)),
        np.log1p(lines[:, 4]) - 0.3 * np.log1p(size),
        np.log((lines[:, 5] + 0.5) / (m + 1)),
    ]
    return np.stack(columns, axis=1) if len(array) else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class Discriminant:
    """Class means and Cholesky factors of the standardised statistics."""

    constant: float | None
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverses of the Cholesky factors
    offsets: list[float]  # log prior minus half the log-determinant

    @classmethod
    def fitted(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled=POOLED, diagonal=DIAGONAL) -> Discriminant:
        """From count, sum and sum of outer products of each class."""
        none = np.zeros(0)
        if not moments.get(0) or not moments.get(1):
            return cls(float(max(moments)) if moments else 0.5, none, none, [], [], [])
        total = sum(m[0] for m in moments.values())
        centre = sum(m[1] for m in moments.values()) / total
        spread = np.diag(sum(m[2] for m in moments.values())) / total - centre**2
        scale = np.sqrt(np.maximum(spread, 1e-6))
        means, scatters, counts = [], [], []
        for label in (0, 1):
            n, first, second = moments[label]
            mean = first / n
            scatter = (second / n - np.outer(mean, mean)) / np.outer(scale, scale)
            means.append((mean - centre) / scale)
            scatters.append(scatter)
            counts.append(n)
        shared = sum(c * s for c, s in zip(counts, scatters, strict=True)) / total
        factors, offsets = [], []
        for n, scatter in zip(counts, scatters, strict=True):
            few = 1 / (1 + n / len(FEATURES))
            part = max(pooled, few)
            cov = (1 - part) * scatter + part * shared
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-3 * np.eye(len(cov))
            lower = np.linalg.cholesky(cov)
            factors.append(np.linalg.inv(lower))
            offsets.append(float(np.log(n / total) - np.log(np.diag(lower)).sum()))
        return cls(None, centre, scale, means, factors, offsets)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.centre) / self.scale
        density = [
            off - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, off in zip(self.means, self.factors, self.offsets, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip((density[0] - density[1]) / TEMPERATURE, -700, 700)))


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and statistics of every row."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = statistics(texts(part, "text"))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), flat], names=["id", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(vectors, f"id {kind}, x array<double>")


def train(vectors: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Discriminant:
    """Moments of all labelled vectors outside the held-out fold, summed by Spark."""
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), F.col(label).cast("int").alias("y"))
    learned = vectors.where(F.col("id").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT)).join(marked, "id")
    d = len(FEATURES)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, d)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for k, total in sums.items():
                own = x[y == k]
                total += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).reshape(-1)])
        for k, total in sums.items():
            if total[0]:
                yield pa.record_batch({"y": pa.array([k] * len(total), pa.int32()), "i": np.arange(len(total), dtype=np.int32), "v": total})

    sums = learned.select("x", "y").mapInArrow(summed, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v"))
    moments: dict[int, np.ndarray] = {}
    for y, i, v in sums.collect():  # two classes times 1 + d + d * d numbers
        moments.setdefault(y, np.zeros(1 + d + d * d))[i] = v
    return Discriminant.fitted({y: (m[0], m[1 : 1 + d], m[1 + d :].reshape(d, d)) for y, m in moments.items()})


def score(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """id and score of every row."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shared.value.scores(x))], names=["id", "score"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(scored, f"id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    vectors = written(described(docs), "quality-vectors")
    scored = score(vectors, train(vectors, labels))
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
