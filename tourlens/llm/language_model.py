"""Scores of texts by a weighted backoff automaton over word n-grams, counted in all training texts.

Model: the probability of a word after a context is (count of context and word + STRENGTH * probability after the context without its
first word) / (count of the context + STRENGTH), down to the single word, (count + 0.5) / (words + 0.5 * (distinct words + 1)).
As an automaton: states are the contexts that were counted, the empty one included. A counted word leaves a state by an arc with its
log-probability; any other takes the failure arc, log10(STRENGTH / (count of the context + STRENGTH)), to the context without its first
word. A text is read from left to right, from the state of beginnings: the state is carried, weights are added up.

The counts grow with the texts, so neither they nor the automaton are ever in one place:

1. Texts are packed into blocks of BLOCK words: numbers into the block's own vocabulary of 64-bit word hashes.
2. Each block asks for the counts of its distinct n-grams, of every length, and brings its own training counts along. Keys are dealt by
   their leading bits to buckets of about BUCKET keys; the bucket adds the counts up and answers each block, in the order of its keys.
3. A block meets its answers: they are the part of the automaton that its texts can reach. All its texts are traversed.

A frequent n-gram is one key per block, so no key is a task's work. Word hashes of 64 bits are taken for words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import slices, texts, written
from tourlens.llm.shingles import TOGETHER, mixed, word_hashes

#: Words of a block and keys of a bucket, about: a task holds one of them at a time. A longer text is a block of its own.
BLOCK, BUCKET = 1 << 20, 1 << 21
#: Longest n-gram, and the weight of the shorter context in words.
ORDER, STRENGTH = 2, 200.0
#: Words that one lane of the traversal reads.
LANE = 256
END, BEGIN = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x5851F42D4C957F2D)
_C = np.uint64(0xD6E8FEB86659FD93)


def _pressed(numbers: np.ndarray) -> bytes:
    """The size and the compressed bytes of an array."""
    raw = np.ascontiguousarray(numbers).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpressed(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd"), dtype)


def _keys_out(keys: np.ndarray) -> bytes:
    """Ascending keys as six or eight bytes of each difference."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = 6 if steps.max() < 2**48 else 8
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _keys_in(data: bytes) -> np.ndarray:
    width = data[0]
    steps = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    with np.errstate(over="ignore"):
        return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _packed(docs: DataFrame) -> DataFrame:
    """Texts in blocks: block, keys and train of its texts, their lengths with the end, words by number in the vocabulary."""
    kind = docs.schema["key"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, block = 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            keys, train, lengths, words = (list(x) for x in zip(*held, strict=True))
            train, lengths, words = np.concatenate(train), np.concatenate(lengths), np.concatenate(words)
            vocabulary, numbers = np.unique(words, return_inverse=True)
            held.clear()
            keys = pa.concat_arrays(keys)
            pressed = [_pressed(x) for x in (train, lengths, numbers.astype(np.int32), vocabulary)]
            sums = [len(words), int(lengths[train].sum()), int(train.sum())]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    *(pa.array([x], pa.binary()) for x in pressed),
                    *(pa.array([x], pa.int64()) for x in sums),
                ],
                names=["block", "keys", "train", "lengths", "numbers", "vocabulary", "words", "train_words", "train_texts"],
            )

        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                hashes, n = word_hashes(texts(part, "text"))
                ends = np.cumsum(n)
                words = np.insert(hashes, ends, END)
                held.append((part.column("key"), part.column("train").to_numpy(zero_copy_only=False).astype(bool), n + 1, words))
                size += len(words)
                if size >= BLOCK:
                    yield row()
                    size, block = 0, block + 1
        if held:
            yield row()

    schema = f"block long, keys array<{kind}>, train binary, lengths binary, numbers binary, vocabulary binary, words long, train_words long, train_texts long"
    return docs.mapInArrow(packed, schema)


class _Block:
    """The texts of a block, its words in order and its n-grams."""

    def __init__(self, row: dict):
        self.train = _unpressed(row["train"], np.bool_)
        self.lengths = _unpressed(row["lengths"], np.int64)
        self.numbers = _unpressed(row["numbers"], np.int32)
        self.vocabulary = _unpressed(row["vocabulary"], np.uint64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.numbers)) - np.repeat(self.starts, self.lengths)
        self.learned = np.repeat(self.train, self.lengths)

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """n, distinct keys, places where an n-gram ends and its key's number, for 1 to `order` words; texts begin with BEGIN."""
        yield 1, self.vocabulary, np.arange(len(self.numbers)), self.numbers
        words = self.vocabulary[self.numbers]
        keys = words
        for n in range(2, order + 1):
            with np.errstate(over="ignore"):
                before = np.concatenate([[BEGIN], keys[:-1]])
                before[self.place == 0] = BEGIN
                keys = mixed(mixed(before * _C + np.uint64(n)) + words)
            places = np.flatnonzero(self.place >= n - 2)
            distinct, number = np.unique(keys[places], return_inverse=True)
            yield n, distinct, places, number


def _requests(packed: DataFrame, order: int, buckets: int) -> DataFrame:
    """Of each block, length of n-gram and bucket: the distinct keys and their training counts."""

    def requested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                for n, keys, places, number in block.grams(order):
                    counts = np.bincount(number[block.learned[places]], minlength=len(keys))
                    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
                    columns = (
                        [n] * (len(cuts) - 1),
                        [int(bucket[a]) for a in cuts[:-1]],
                        [row["block"]] * (len(cuts) - 1),
                        [_keys_out(keys[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)],
                        [_pressed(counts[a:b].astype("<u4")) for a, b in zip(cuts, cuts[1:], strict=False)],
                    )
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["n", "bucket", "block", "keys", "counts"])

    return packed.mapInArrow(requested, "n int, bucket long, block long, keys binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """Of each request the counts over all blocks, in its order; `fresh`, in one row of a bucket, counts its keys that were met in training."""

    def answered(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_keys_in(r["keys"]) for r in rows]
        ends = np.cumsum([len(k) for k in keys])
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(number, weights=np.concatenate([_unpressed(r["counts"], "<u4") for r in rows]), minlength=len(distinct)).astype(np.int64)
        answers = np.split(counts[number], ends[:-1])
        fresh = [int((counts > 0).sum())] + [0] * (len(rows) - 1)
        return pa.table(
            {
                "n": table.column("n"),
                "bucket": table.column("bucket"),
                "block": table.column("block"),
                "counts": pa.array([_pressed(a) for a in answers], pa.binary()),
                "fresh": pa.array(fresh, pa.int64()),
            }
        )

    return requests.groupBy("n", "bucket").applyInArrow(answered, "n int, bucket long, block long, counts binary, fresh long")


def _walked(starts: np.ndarray, lengths: np.ndarray, met: list[np.ndarray], arcs: list[np.ndarray], failures: list[np.ndarray]) -> np.ndarray:
    """Log-probability of each text: many lanes traverse the automaton side by side, each from left to right.

    met[n - 1][i] says whether the n-gram that ends at place i was counted, arcs holds its weight and failures the weight of the
    failure arc of the state of n - 1 words before i. A lane that begins inside a text reads the words before it first, which lead to
    the state that the text is in there.
    """
    order = len(met)
    lanes = -(-lengths // LANE)
    text = np.repeat(np.arange(len(starts)), lanes)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
    begin, end = starts[text] + at, starts[text] + np.minimum(at + LANE, lengths[text])
    now = np.maximum(begin - (order - 1), starts[text])
    # The state is the number of words of the context; the beginning of a text is a context of one.
    state = np.where(now == starts[text], min(1, order - 1), 0)
    total = np.zeros(len(text))
    while len(active := np.flatnonzero(now < end)):
        i, s = now[active], state[active]
        weight, arrived = np.zeros(len(active)), np.zeros(len(active), bool)
        for n in range(order, 1, -1):
            here = ~arrived & (s == n - 1)
            hit = here & met[n - 1][i]
            weight[hit] += arcs[n - 1][i[hit]]
            miss = here & ~hit
            weight[miss] += failures[n - 1][i[miss]]
            s = np.where(hit, min(n, order - 1), np.where(miss, n - 2, s))
            arrived |= hit
        weight[~arrived] += arcs[0][i[~arrived]]
        s = np.where(arrived, s, np.minimum(met[0][i], order - 1))
        total[active] += np.where(i >= begin[active], weight, 0.0)
        state[active], now[active] = s, i + 1
    return np.bincount(text, weights=total, minlength=len(starts))


def _scored(block: _Block, counts: dict[int, np.ndarray], order: int, strength: float, words: int, distinct: int, train_texts: int):
    """n_known, base_score and score of the texts of a block."""
    size = len(block.numbers)
    met, arcs, failures = [], [], []
    below = context = None
    for n, _, places, number in block.grams(order):
        own = np.zeros(size, np.int64)
        own[places] = counts[n][number]
        if n == 1:
            probability = (own + 0.5) / (words + 0.5 * (distinct + 1))
            failures.append(np.zeros(0))
            base = np.log10(probability)
        else:
            context = np.concatenate([[0], below[:-1]])
            if n == 2:
                context[block.place == 0] = train_texts
            probability = (own + strength * probability) / (context + strength)
            failures.append(np.log10(strength / (context + strength)))
        met.append(own > 0)
        arcs.append(np.log10(probability))
        below = own
    known = np.add.reduceat(met[0].astype(np.int64), block.starts)
    return known, np.add.reduceat(base, block.starts), _walked(block.starts, block.lengths, met, arcs, failures)


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """A row per row: key, train, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text).

    Tokens are runs without ASCII white space, A-Z lower-cased, then one end. Texts where `train` holds are learned from; all are scored.

    Defined cases: null and empty texts are the end alone; a null in `train` is false; repeated rows count, and are scored, each time; null keys
    stay; an empty table gives an empty result, and without training texts every word has the same probability. Only the key, the text and what
    `train` needs are read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    packed = written(_packed(rows), "lm-packed")
    sums = packed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "train_words", "train_texts")]).first()
    answers = written(_answers(_requests(packed, order, 1 + sums["words"] // BUCKET)), "lm-answers")
    distinct = answers.where("n = 1").agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0]
    kind = rows.schema["key"].dataType.simpleString()
    words, train_texts = sums["train_words"], sums["train_texts"]

    def traversed(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left.to_pylist()[0])
        counts: dict[int, list] = {n: [] for n in range(1, order + 1)}
        found = right.sort_by([("n", "ascending"), ("bucket", "ascending")])
        for n, data in zip(found.column("n").to_pylist(), found.column("counts").to_pylist(), strict=True):
            counts[n].append(_unpressed(data, np.int64))
        whole = {n: np.concatenate(parts) for n, parts in counts.items()}
        known, base, total = _scored(block, whole, order, strength, words, distinct, train_texts)
        keys = left.column("keys").combine_chunks().flatten()
        columns = (block.train, block.lengths, known, np.full(len(known), words), base, total)
        return pa.table([keys, *map(pa.array, columns)], names=names)

    names = ["key", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = f"key {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = packed.groupBy("block").cogroup(answers.select("n", "bucket", "block", "counts").groupBy("block")).applyInArrow(traversed, schema)
    return scored.withColumnRenamed("key", key)
