"""N-gram Jaccard self-join by a token-group matrix.

Documents are sets of word shingles; two link when their Jaccard similarity reaches a percentage. Equal sets are one
class from the start. Similar documents are partitioned into groups, and the matrix holds which token is
in which group's union. A document can only link into a group that holds enough of its
tokens, so a group is opened, its members compared one by one, only if the overlap with its union reaches the bound.

1. Every document gets its size, the hash of its set and its signature: the first n - needed + SHARED tokens in a
   global order, rare tokens first, of which a partner must have at least SHARED in its own (fewer in tiny sets). The
   order comes from a sketch of all documents' tokens with a fixed number of counters, so what is broadcast never grows.
2. Partition: among documents with signature tokens in common and of like size, each is compared with the
   smallest id it shares most tokens with; certified links tie near copies together into groups without
   ever listing their pairs. Large groups are split by a hash of the id, so that a union stays small.
3. Matrix: signature tokens that occur in several groups give the candidates (document, foreign group) with enough of
   them in common, and few enough tokens before them that the other lacks. A link to any member ties two groups, so a few members are compared first; for what stays
   apart, the overlap with the group's union is bounded; qualifying groups are opened, members compared exactly.
4. Components of all links. Links inside a group are implied by its certified ones.

Work on hot tokens: documents that share one and are already in one group cost a row each.

Defined cases: null texts and texts without words are empty sets, linked with nothing, component their own id. Rows that
repeat an id are one document whose texts all count; each row is returned with its own size. A null id takes the component
of its equal sets (null if none has an id) and is compared with nothing. Only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourlens.llm.common import distilled, slices, texts, written
from tourlens.llm.components import components
from tourlens.llm.shingles import TOGETHER, mixed, shingle_sets

#: Counters of the frequency sketch, cut into pieces that are summed apart.
SKETCH_BITS, PIECES, LANES = 20, 64, 32
#: Tokens of a group's union, about: larger groups are split.
UNION_TOKENS = 50_000
#: Signature tokens that linked sets have in common at least (as many as they need, if fewer).
SHARED = 3
#: Members of a group that are compared before it is opened.
FIRST = 4


def needed(n: np.ndarray | int, percent: int):
    """Tokens a set of n must share with a partner at least."""
    return -(-percent * n // 100)


def _frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """Levels of frequency by the leading bits of a token, over all documents.

    Counters are added in the tasks, then by Spark in two rounds; one byte per counter comes back.
    """
    piece = (1 << SKETCH_BITS) // PIECES

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                hashes, _ = shingle_sets(texts(part, "text"), k)
                total += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        if total.any():
            lane = TaskContext.get().partitionId() % LANES
            for p in range(PIECES):
                yield _piece(p, lane, total[p * piece : (p + 1) * piece])

    def _piece(p: int, lane: int, counts: np.ndarray) -> pa.RecordBatch:
        low = np.minimum(counts, 2**32 - 1).astype("<u4")
        return pa.record_batch(
            {"piece": pa.array([p], pa.int32()), "lane": pa.array([lane], pa.int32()), "counts": pa.array([zlib.compress(low.tobytes(), 1)], pa.binary())}
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for p, lane, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(counts), "<u4").astype(np.int64)
                sums[p, lane] = sums[p, lane] + own if (p, lane) in sums else own
        for (p, lane), counts in sums.items():
            yield _piece(p, lane, counts)

    schema = "piece int, lane int, counts binary"
    parts = docs.mapInArrow(counted, schema).repartition(F.col("piece"), F.col("lane")).mapInArrow(added, schema)
    whole = parts.withColumn("lane", F.lit(0)).repartition(F.col("piece")).mapInArrow(added, schema)
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for p, _, counts in whole.collect():  # PIECES rows of a fixed size
        out[p * piece : (p + 1) * piece] += np.frombuffer(zlib.decompress(counts), "<u4")
    return np.minimum(8 * np.log2(1 + out), 255).astype(np.uint8)


def _profiles(docs: DataFrame, k: int, percent: int, levels: np.ndarray) -> DataFrame:
    """id, size, hash of the set (two longs) and signature of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                hashes, offsets = shingle_sets(texts(part, "text"), k)
                n = np.diff(offsets)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(s)))]) for s in (0x5851F42D, 0x14057B7E)]
                own = [(s[offsets[1:]] - s[offsets[:-1]]).view(np.int64) for s in sums]
                doc = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((hashes, level[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], doc))
                place = np.arange(len(hashes)) - offsets[:-1][doc]
                must = needed(n, percent)
                first = place < (n - must + np.minimum(must, SHARED))[doc]
                lengths = np.bincount(doc[first], minlength=len(n))
                signature = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(hashes[order][first].view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(own[0]), pa.array(own[1]), signature], names=["id", "n", "h1", "h2", "signature"]
                )

    return docs.mapInArrow(profiled, "id long, n long, h1 long, h2 long, signature array<long>")


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """v and tokens of the documents named in a column id."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                hashes, offsets = shingle_sets(texts(part, "text"), k)
                tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), tokens], names=["v", "tokens"])

    named = written(ids.distinct(), "join-ids")
    found = docs.join(named, "id", "left_semi").mapInArrow(made, "v long, tokens array<long>")
    return written(found.where(F.size("tokens") > 0), "join-sets")


def _shared(pairs: DataFrame, keep: str, percent: int) -> DataFrame:
    """Pairs (a, b) whose arrays x and y overlap enough: 'jaccard' of two sets, or 'bound' of x in a union y."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            good = []
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                both = len(np.intersect1d(p, q, assume_unique=True))
                if keep == "bound":
                    good.append(both >= needed(len(p), percent))
                else:
                    good.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    kinds = dict(pairs.dtypes)
    return pairs.select("a", "b", "x", "y").mapInArrow(compared, f"a {kinds['a']}, b {kinds['b']}")


def _like(n: Column, m: Column, percent: int) -> Column:
    return (100 * n >= percent * m) & (100 * m >= percent * n)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among pairs (a, b) of ids."""
    left = sets.select(F.col("v").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("v").alias("b"), F.col("tokens").alias("y"))
    return _shared(pairs.join(left, "a").join(right, "b"), "jaccard", percent)


def _groups(rows: DataFrame, postings: DataFrame, k: int, percent: int) -> DataFrame:
    """Groups of near copies by certified links, v and g: the smallest id of a token and size, the one met most often."""
    stars = written(postings.groupBy("token", "band").agg(F.min("v").alias("star"), F.min_by("n", "v").alias("star_n")), "join-stars")
    met = postings.join(stars, ["token", "band"]).where("v <> star").where(_like(F.col("n"), F.col("star_n"), percent))
    met = met.groupBy("v", "n", "star").agg(F.count("*").alias("shared")).where(_enough(percent))
    best = met.groupBy("v").agg(F.max_by("star", F.struct("shared", -F.col("star"))).alias("star"))
    pairs = written(best.select(F.col("star").alias("a"), F.col("v").alias("b")), "join-pairs")
    sets = _sets(rows, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), k)
    certified = components(_verified(pairs, sets, percent))
    return certified.select(F.col("vertex").alias("v"), F.col("component").alias("g"))


def _enough(percent: int) -> Column:
    return F.col("shared") >= F.least(F.ceil(F.col("n") * percent / 100), F.lit(SHARED))


def _in_common(n: Column, least: Column, most: Column, percent: int) -> Column:
    """Signature tokens that a set of n has in common with any partner of least to most tokens, at least.

    Linked sets of n and m have percent / (100 + percent) of n + m in common. Of the one whose signature ends first, what
    lies beyond the end is no more than the rest of that set; all else is in both signatures. The bound is lowest at an
    end of the range; rounding can lower it by one in between.
    """

    def beyond(size: Column) -> Column:
        must = F.ceil(size * percent / 100)
        return must - F.least(must, F.lit(SHARED))

    def bound(m: Column) -> Column:
        return F.ceil((n + m) * percent / (100 + percent)) - F.greatest(beyond(n), beyond(m))

    low = F.greatest(least, F.ceil(n * percent / 100))
    high = F.least(most, F.floor(n * 100 / percent))
    lowest = F.least(bound(low), bound(high))
    return F.greatest(F.when(low == high, lowest).otherwise(lowest - 1), F.least(F.ceil(n * percent / 100), F.lit(SHARED)))


def _reaching(placed: DataFrame, percent: int) -> DataFrame:
    """Signature tokens that occur in several groups, of documents with enough of them, and `reach`.

    If two documents of different groups share a token, all that they share before it stands before it in both signatures,
    so tokens of one group only that a document has before it are not shared. `reach` is the document's size without those: the most
    that it can have in common with a document of another group that it shares this token with.
    """
    foreign = placed.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high").select("token")
    own = Window.partitionBy("v")
    before = F.row_number().over(own.orderBy("place")) - 1
    left = placed.join(foreign, "token").withColumn("before", before).withColumn("shared", F.count("*").over(own))
    reach = F.col("n") - (F.col("place") - F.col("before"))
    return left.where(_enough(percent)).withColumn("reach", reach).drop("place", "before", "shared")


def _links_between(rows: DataFrame, postings: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Links between different groups by the matrix of tokens and groups: a, b; None without candidates."""
    members = postings.select("v", "n").distinct().join(groups, "v", "left").withColumn("g", F.coalesce("g", "v"))
    members = written(members, "join-grouped")
    heavy = members.groupBy("g").agg(F.sum("n").alias("weight")).where(F.col("weight") > UNION_TOKENS)
    heavy = written(heavy, "join-heavy")
    part = F.coalesce(F.pmod(F.xxhash64("v"), F.ceil(F.col("weight") / UNION_TOKENS)), F.lit(0))
    members = written(members.join(heavy, "g", "left").select("v", "n", "g", part.alias("part")), "join-members")
    placed = written(postings.join(members, ["v", "n"]).select("token", "place", "v", "n", "g", "part"), "join-placed")
    placed = written(_reaching(placed, percent), "join-reaching")
    matrix = placed.groupBy("token", "g", "part").agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max("reach").alias("h_reach"),
        *[F.min_by("v", F.xxhash64("v", F.lit(i))).alias(f"r{i}") for i in range(FIRST)],
    )
    matrix = written(matrix.withColumnRenamed("g", "h").withColumnRenamed("part", "h_part"), "join-matrix")
    smallest = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    reached = (100 + percent) * F.least("reach", "h_reach") >= percent * (F.col("n") + smallest)
    asked = (
        placed.join(matrix, (placed["token"] == matrix["token"]) & (F.col("h") < F.col("g")))
        .where((100 * F.col("n") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n")) & reached)
        .groupBy("v", "n", placed["g"], "h", "h_part")
        .agg(
            F.count("*").alias("shared"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
            *[F.mode(f"r{i}").alias(f"r{i}") for i in range(FIRST)],
        )
        .where(F.col("shared") >= _in_common(F.col("n"), F.col("least"), F.col("most"), percent))
        .select(
            F.col("v").alias("a"),
            "g",
            F.struct(F.col("h").alias("g"), F.col("h_part").alias("part")).alias("b"),
            F.array_distinct(F.array(*[f"r{i}" for i in range(FIRST)])).alias("firsts"),
        )
    )
    asked = written(asked, "join-asked")
    if asked.isEmpty():
        return None
    held = written(members.join(asked.select("b.*").distinct(), ["g", "part"], "left_semi"), "join-held")
    sets = _sets(rows, asked.select(F.col("a").alias("id")).union(held.select("v")), k)
    # A link with any member ties the whole groups, so a few members are compared before a group is opened.
    near = asked.select("a", F.explode("firsts").alias("b"))
    sized = members.select("v", "n").distinct()
    near = near.join(sized.toDF("a", "n"), "a").join(sized.toDF("b", "m"), "b").where(_like(F.col("n"), F.col("m"), percent))
    tying = written(_verified(near.select("a", "b").distinct(), sets, percent), "join-tying")
    homes = members.select("v", "g").distinct()
    tied = tying.join(homes.toDF("a", "ga"), "a").join(homes.toDF("b", "gb"), "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    tied = components(tied)
    own, other = tied.toDF("g", "own"), tied.toDF("other", "theirs")
    left_open = (
        asked.join(own, "g", "left")
        .join(other, F.col("b.g") == F.col("other"), "left")
        .where(~(F.coalesce("own", "g") == F.coalesce("theirs", F.col("b.g"))))
        .select("a", "b")
    )
    left_open = written(left_open, "join-left")
    if left_open.isEmpty():
        return tying
    unions = written(
        held.join(left_open.select("b.*").distinct(), ["g", "part"], "left_semi")
        .join(sets, "v")
        .groupBy("g", "part")
        .agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("y"))
        .select(F.struct("g", "part").alias("b"), "y"),
        "join-unions",
    )
    left = sets.select(F.col("v").alias("a"), F.col("tokens").alias("x"))
    qualifying = written(_shared(left_open.join(left, "a").join(unions, "b"), "bound", percent), "join-qualifying")
    opened = (
        qualifying.select("a", "b.g", "b.part")
        .join(held.select(F.col("v").alias("b"), F.col("n").alias("m"), "g", "part"), ["g", "part"])
        .join(members.select(F.col("v").alias("a"), "n"), "a")
        .where(_like(F.col("n"), F.col("m"), percent))
        .select("a", "b")
        .distinct()
    )
    return tying.union(written(_verified(opened, sets, percent), "join-found"))


def linked_classes(rows: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """v and component of the classes (v, n, signature) that link with another."""
    postings = classes.where("v is not null").select("v", "n", F.posexplode("signature").alias("place", "token"))
    several = written(postings.groupBy("token").count().where("count > 1").select("token"), "join-tokens")
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)))
    postings = written(postings.join(several, "token").withColumn("band", band), "join-postings")
    groups = _groups(rows, postings, k, percent)
    found = _links_between(rows, postings, groups, k, percent)
    if found is None:
        return groups.select("v", F.col("g").alias("component"))
    # Links between groups tie the groups: components of a graph whose vertices are groups.
    for end in ("a", "b"):
        found = found.join(groups.select(F.col("v").alias(end), F.col("g").alias(f"{end}_group")), end, "left")
    found = found.select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b"))
    tied = components(found)
    inside = groups.join(tied, groups["g"] == tied["vertex"], "left").select("v", F.coalesce("component", "g").alias("component"))
    return inside.union(tied.join(groups, tied["vertex"] == groups["v"], "left_anti").select("vertex", "component"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """A row per row: the id, n_shingles and component_id, the smallest id it is linked with."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    profiles = written(_profiles(rows, k, percent, _frequencies(rows.select("text"), k)), "join-profiles")
    classes = profiles.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("v"), F.first("signature").alias("signature"))
    classes = written(classes, "join-classes")

    def linked() -> DataFrame:
        found = linked_classes(rows, classes.select("v", "n", "signature"), k, percent)
        return found.groupBy("v").agg(F.min("component").alias("component"))

    found = distilled(docs.sparkSession, "join-components", linked)
    labels = classes.select("h1", "h2", "n", "v").join(found, "v", "left")
    labels = written(labels.select("h1", "h2", "n", F.coalesce("component", "v").alias("component")), "join-labels")
    return (
        profiles.select("id", "n", "h1", "h2")
        .join(labels, ["h1", "h2", "n"], "left")
        .select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays, the one with the smallest id; all columns as they came."""

    def copies() -> DataFrame:
        found = jaccard_components(docs, key, text, k, percent)
        return found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("_id")).distinct()

    gone = distilled(docs.sparkSession, "join-gone", copies)
    return docs.join(gone, docs[key] == gone["_id"], "left_anti")
