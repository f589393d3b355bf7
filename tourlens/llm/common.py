"""What the operators of this package share: reading, folds, text slices for numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens.sources import workspace

#: Bytes of text that numpy code looks at together; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: ASCII white space, as the contracts of the operators have it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: Column, n: int) -> Column:
    """Remainder of the key's checksum; null keys are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(0))


def drawn(key: Column) -> Column:
    """A number from 0 to 1 by the digest of a key, in the order of the digest."""
    return F.xxhash64(key) / 2.0**64 + 0.5


def part(most: int, n: int) -> float:
    """`drawn` below which `most` of n keys lie: twice as many are expected there, so that fewer are next to impossible."""
    return min(1.0, (2 * most + 100) / max(n, 1))


#: Folders of tables written inside `distilled`, innermost last.
_passing: list[list[str]] = []


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage, read again as often as needed."""
    path = workspace.new_folder(df.sparkSession, purpose)
    if _passing:
        _passing[-1].append(path)
    return workspace.settled(df, path)


def distilled(spark: SparkSession, purpose: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What `make` returns as a table; the tables written on the way to it are deleted."""
    _passing.append([])
    try:
        path = workspace.new_folder(spark, purpose)
        result = workspace.settled(make(), path)
    finally:
        for passed in _passing.pop():
            workspace.delete(spark, passed)
    if _passing:
        _passing[-1].append(path)
    return result


def texts(batch: pa.RecordBatch, column: int | str) -> pa.Array:
    """A text column of a batch with empty texts for nulls."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def bytes_and_offsets(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string array and where each text begins and ends."""
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(ends):
        ends = np.zeros(1, np.int64)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, column: int | str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut by rows so that the texts of a part have about `most` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
