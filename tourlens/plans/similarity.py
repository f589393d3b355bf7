"""Which artists share venues: Jaccard similarity of artists' venue sets, all pairs or the best of each artist.

Artists are numbered by name, so numbers order and break ties as names do, and venues from rare to crowded.

Artists that meet are sent as lists, a row for each visit, to the task of the artist, and counted there. The best k of each
artist are ranked there too while that is linear in the visits. Else they are found without listing all pairs. Artists with equal sets are one class, known by its
k + 1 first artists. Classes are sorted by their venues, rare ones first, and cut into blocks; like sets are
neighbours. Blocks are matched with themselves and their neighbours, and each class with the first artists of its most
crowded venue, which gives each class a list and with it a threshold: score and number of its last entry. Of the other pairs of
blocks only those are opened that can beat the weakest threshold of a block, by sizes, venues in common and, at
an equal score, numbers. Opened pairs return the best k + 1 of each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourlens.sources import workspace

# A venue's artists are compared in blocks of about this many.
BLOCK = 1000
# Classes of a block of the top-k join, as a power of two.
CLASSES = 7
# Matches that a task holds at once.
MATCHES = 1 << 22
# Artists met that a task counts, and the most tasks that count them.
ENTRIES, MOST_TASKS = 1 << 21, 20_000
# The best are taken from all that are met if these are at most so many for each visit: linear work then.
MET_PER_VISIT = 32


@dataclass(frozen=True)
class Sets:
    """artists: artist, artist_name, n (venues); venues: venue, venue_name, crowd (artists); visits: artist, venue, n, crowd."""

    artists: DataFrame
    venues: DataFrame
    visits: DataFrame


def _settled(df: DataFrame, purpose: str) -> DataFrame:
    return workspace.settled(df, workspace.new_folder(df.sparkSession, purpose))


def _numbered(df: DataFrame, number: str, *order: str) -> DataFrame:
    """Rows with increasing numbers in an order, given by the tasks that sort them."""
    return _settled(df.orderBy(*order).withColumn(number, F.monotonically_increasing_id()), f"similarity-{number}")


def _dense(df: DataFrame, number: str) -> DataFrame:
    """The same order with numbers from 0 without gaps: short ones, as lists of them are shuffled."""
    # Numbers of one task follow each other, those of the next start at 1 << 33 more. There is one row per task to add up.
    task, start = F.shiftright(number, 33), F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")
    starts = df.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows")).select("_task", start.alias("_start"))
    rows = df.withColumn("_task", task).join(starts, "_task")
    rows = rows.withColumn(number, (F.col("_start") + F.col(number).bitwiseAND((1 << 33) - 1)).cast("int")).drop("_task", "_start")
    return _settled(rows, f"similarity-{number}")


def venue_sets(fact: DataFrame) -> Sets:
    """Distinct visits with numbers for names.

    Each artist's number of venues travels with the visits: joining it before pairs are made
    moves far fewer rows than looking it up twice for every pair afterwards.
    """
    named = (
        fact.where(F.col("artist_name").isNotNull())
        .select("artist_name", F.trim("venue_name").alias("venue_name"))
        .where("venue_name != ''")
        .distinct()
    )
    named = _settled(named, "similarity-visits")
    artists = _numbered(named.groupBy("artist_name").agg(F.count("*").alias("n")), "artist", "artist_name")
    artists = _dense(artists, "artist")
    venues = _numbered(named.groupBy("venue_name").agg(F.count("*").alias("crowd")), "venue", "crowd", "venue_name")
    visits = named.join(artists, "artist_name").join(venues, "venue_name").select("artist", "venue", "n", "crowd")
    return Sets(artists, venues, _settled(visits, "similarity-numbered"))


def _lists(visits: DataFrame, block_size: int) -> DataFrame:
    """The artists of each venue in blocks: venue, block, blocks, members (n and artist, in that order), other columns of visits."""
    more = [c for c in visits.columns if c not in ("artist", "venue", "n", "crowd")]
    rows = visits.withColumn("blocks", F.ceil(F.col("crowd") / F.lit(block_size)).cast("int"))
    lists = (
        rows.withColumn("block", F.pmod(F.xxhash64("artist"), F.col("blocks")).cast("int"))
        .groupBy("venue", "block")
        .agg(F.sort_array(F.collect_list(F.struct("n", "artist"))).alias("members"), *[F.first(c).alias(c) for c in ("blocks", *more)])
    )
    return _settled(lists, "similarity-lists")


def _numbers(members: Column) -> Column:
    return F.transform(members, lambda m: m["artist"])


def met(visits: DataFrame, block_size: int = BLOCK, both: bool = False) -> DataFrame:
    """(artist, others): at each venue each artist with those that come after it by (n, artist), or with `both` all; more columns of visits stay.

    A row for each visit and block of its venue, with a number for each artist met: far less to shuffle than a row for each
    pair. What can go wrong is one crowded venue landing in one task: its artists are hashed into blocks, and each
    combination of two blocks is joined on its own. An artist with many venues comes last, so that it meets few: the others meet it.
    """
    lists = _lists(visits, block_size)
    more = [c for c in lists.columns if c not in ("venue", "block", "blocks", "members")]
    small = lists.where("blocks = 1").select(F.posexplode("members").alias("at", "own"), "members", *more)
    after = _numbers(F.col("members")) if both else _numbers(F.slice("members", F.col("at") + 2, F.size("members")))
    crowded = lists.where("blocks > 1")
    left = crowded.select("venue", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), F.col("members").alias("owners"), *more)
    right = crowded.select("venue", F.col("block").alias("other"), "members")
    parts = left.join(right, ["venue", "other"]).select(F.explode("owners").alias("own"), "members", *more)
    later = F.col("members") if both else F.filter("members", lambda m: m > F.col("own"))
    rows = [df.select(F.col("own.artist").alias("artist"), others.alias("others"), *more) for df, others in ((small, after), (parts, _numbers(later)))]
    return rows[0].unionByName(rows[1]).where(F.size("others") > 0)


def _entries(sets: Sets) -> int:
    """How many artists are met at all venues, each pair once a venue."""
    return int(sets.venues.agg(F.sum(F.expr("crowd * (crowd - 1) div 2"))).first()[0] or 0)


def _gathered(rows: DataFrame, entries: int) -> DataFrame:
    """(artist, other) for each artist met, the rows of an artist in one task, and a bounded number of rows in each."""
    tasks = min(MOST_TASKS, 1 + entries // ENTRIES)
    more = [c for c in rows.columns if c != "others"]
    return rows.repartition(tasks, "artist").select(*more, F.explode("others").alias("other"))


def venue_similarity(
    fact: DataFrame, with_detail: bool = True, block_size: int = BLOCK
) -> DataFrame:
    """Pairs of artists with shared venues, their Jaccard similarity and, if asked, the venues.

    Unordered; readers sort. Pairs are aggregated by numbers; without detail nothing but numbers is.
    """
    sets = venue_sets(fact)
    visits = sets.visits.join(sets.venues.select("venue", "venue_name"), "venue") if with_detail else sets.visits
    shared = [F.count("*").alias("shared_venues")]
    if with_detail:
        shared.append(F.array_join(F.sort_array(F.collect_list("venue_name")), "; ").alias("shared_venues_detail"))
    pairs = _gathered(met(visits, block_size), _entries(sets)).groupBy("artist", "other").agg(*shared)
    mine = sets.artists.select("artist", F.col("artist_name").alias("own_name"), F.col("n").alias("own_n"))
    theirs = sets.artists.select(F.col("artist").alias("other"), F.col("artist_name").alias("other_name"), F.col("n").alias("other_n"))
    similarity = F.col("shared_venues") / (F.col("own_n") + F.col("other_n") - F.col("shared_venues"))
    first = F.col("artist") < F.col("other")
    return pairs.join(mine, "artist").join(theirs, "other").select(
        F.when(first, F.col("own_name")).otherwise(F.col("other_name")).alias("artist_a"),
        F.when(first, F.col("other_name")).otherwise(F.col("own_name")).alias("artist_b"),
        "shared_venues",
        F.round(similarity, 4).alias("jaccard_similarity"),
        *["shared_venues_detail"] * with_detail,
    )


# --- the best of each artist, without all pairs ----------------------------------------


def _classes(sets: Sets, k: int) -> tuple[DataFrame, DataFrame]:
    """Each artist's class, and the classes in blocks: class, n, venues (from rare to crowded), its k + 1 first members."""
    own = sets.visits.groupBy("artist").agg(F.sort_array(F.collect_set("venue")).alias("venues"))
    own = _settled(own, "similarity-sets")
    first = own.groupBy("venues").agg(F.min("artist").alias("class"))
    rank = F.row_number().over(Window.partitionBy("venues").orderBy("artist"))
    members = own.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("venues").agg(F.sort_array(F.collect_list("artist")).alias("members"))
    listed = members.select(F.col("members")[0].alias("class"), F.size("venues").cast("long").alias("n"), "venues", "members")
    listed = listed.orderBy("venues").withColumn("block", F.shiftright(F.monotonically_increasing_id(), CLASSES))
    return own.join(first, "venues").select("artist", "class"), _settled(listed, "similarity-classes")


def _matched(pairs: DataFrame, packed: DataFrame, k: int) -> DataFrame:
    """Of each pair of blocks (l, r) the k + 1 best artists of r for each class of l: class, other, shared, union, score."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = list(_best_of(row, k))
                if parts:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["class", "other", "shared", "union"])

    left = packed.select(*[F.col(c).alias(f"l_{c}") for c in packed.columns])
    right = packed.select(*[F.col(c).alias(f"r_{c}") for c in packed.columns])
    rows = pairs.join(left, F.col("l") == F.col("l_block")).join(right, F.col("r") == F.col("r_block"))
    wanted = [f"{s}_{c}" for s in "lr" for c in ("class", "n", "venues", "members", "sizes")]
    return rows.select(*wanted).mapInArrow(best, "class long, other long, shared long, union long")


def _scores(shared: np.ndarray, union: np.ndarray) -> np.ndarray:
    """Jaccard similarity in ten-thousandths, halves up."""
    return (20_000 * shared + union) // (2 * union)


def _best_of(row: dict, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Class, other artist, shared venues and union of the best of one pair of blocks."""
    n, m = np.array(row["l_n"]), np.array(row["r_n"])
    venues = np.array(row["r_venues"])
    order = np.argsort(venues, kind="stable")
    owners, venues = np.repeat(np.arange(len(m)), m)[order], venues[order]
    asked, classes = np.array(row["l_venues"]), np.array(row["l_class"])
    members, sizes = np.array(row["r_members"]), np.array(row["r_sizes"])
    ends = np.cumsum(sizes)
    low, high = np.searchsorted(venues, asked, "left"), np.searchsorted(venues, asked, "right")
    begins = np.concatenate([[0], np.cumsum(n)])
    load = np.concatenate([[0], np.cumsum(high - low)])[begins]
    a = 0
    while a < len(n):
        # As many classes of the left block as their matches allow.
        b = max(a + 1, int(np.searchsorted(load, load[a] + MATCHES, "right")) - 1)
        part = slice(begins[a], begins[b])
        count = high[part] - low[part]
        at = np.repeat(low[part] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        who = np.repeat(np.repeat(np.arange(b - a), n[a:b]), count)
        shared = np.bincount(who * len(m) + owners[at], minlength=(b - a) * len(m)).reshape(b - a, len(m))
        union = n[a:b, None] + m[None, :] - shared
        score = _scores(shared, union)
        for i in range(b - a):
            near = np.flatnonzero(shared[i])
            if len(near) > k + 1:
                # Every class brings a member, so the k + 1 best classes and their ties are enough.
                least = np.partition(score[i, near], len(near) - k - 1)[len(near) - k - 1]
                near = near[score[i, near] >= least]
            own = np.repeat(near, sizes[near])
            other = members[np.repeat(ends[near] - np.cumsum(sizes[near]), sizes[near]) + np.arange(len(own))]
            chosen = np.lexsort((other, -score[i, own]))[: k + 1]
            yield np.full(len(chosen), classes[a + i]), other[chosen], shared[i, own[chosen]], union[i, own[chosen]]
        a = b


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The best entries of each class by score, then number; repeated ones count once."""
    found = found.dropDuplicates(["class", "other"]).withColumn("score", F.expr("(20000 * shared + union) div (2 * union)"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def _stars(classes: DataFrame, k: int) -> DataFrame:
    """Each class with the k + 1 first classes of its most crowded venue: entries as of `_matched`."""
    rank = F.row_number().over(Window.partitionBy("venue").orderBy("class"))
    placed = classes.select(F.explode("venues").alias("venue"), "class")
    first = placed.withColumn("rank", rank).where(F.col("rank") <= k + 1).select("venue", F.col("class").alias("star"))
    asked = classes.select(F.element_at("venues", -1).alias("venue"), "class", "n", "venues")
    others = classes.select(F.col("class").alias("star"), F.col("n").alias("m"), F.col("venues").alias("theirs"), "members")
    shared = F.size(F.array_intersect("venues", "theirs")).cast("long")
    rows = asked.join(first, "venue").join(others, "star").withColumn("shared", shared)
    return rows.select("class", F.explode("members").alias("other"), "shared", (F.col("n") + F.col("m") - F.col("shared")).alias("union"))


def _openable(classes: DataFrame, weakest: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs of blocks, not yet done, of which one class of l could gain an entry from r."""
    spans = classes.groupBy("block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("class").alias("first"))
    held = classes.select("block", F.explode("venues").alias("venue")).distinct()
    common = held.select(F.col("block").alias("l"), "venue").join(held.select(F.col("block").alias("r"), "venue"), "venue")
    common = common.groupBy("l", "r").agg(F.count("*").alias("venues"))
    left = spans.join(weakest, "block").select(F.col("block").alias("l"), F.col("low").alias("l_low"), F.col("high").alias("l_high"), "score", "other")
    right = spans.select(F.col("block").alias("r"), F.col("low").alias("r_low"), F.col("high").alias("r_high"), "first")
    pairs = common.join(done, ["l", "r"], "left_anti").join(left, "l").join(right, "r")
    # At most so many venues in common, and sets no smaller than that or the least of the block.
    most = F.least("venues", "l_high", "r_high")
    union = F.greatest("l_low", most) + F.greatest("r_low", most) - most
    pairs = pairs.withColumns({"shared": most, "union": union}).withColumn("bound", F.expr("(20000 * shared + union) div (2 * union)"))
    better = (F.col("bound") > F.col("score")) | ((F.col("bound") == F.col("score")) & (F.col("first") < F.col("other")))
    return pairs.where(better).select("l", "r")


def _all_met(sets: Sets, entries: int) -> DataFrame:
    """All that each artist meets: artist, other, shared, union, score. All of an artist is counted in one task."""
    pairs = _gathered(met(sets.visits, both=True), 2 * entries).where("artist != other").groupBy("artist", "other").agg(F.count("*").alias("shared"))
    own = sets.artists.select("artist", "n")
    theirs = sets.artists.select(F.col("artist").alias("other"), F.col("n").alias("m"))
    pairs = pairs.join(own, "artist").join(theirs, "other").withColumn("union", F.col("n") + F.col("m") - F.col("shared"))
    return pairs.select("artist", "other", "shared", "union", F.expr("(20000 * shared + union) div (2 * union)").alias("score"))


def _best_of_blocks(sets: Sets, k: int) -> DataFrame:
    """The best of each artist without listing all it meets: artist, other, shared, union, score."""
    members, classes = _classes(sets, k)
    rows = F.sort_array(F.collect_list(F.struct("class", "n", "venues", "members")))
    packed = classes.groupBy("block").agg(rows.alias("rows")).select(
        "block",
        *[F.col(f"rows.{c}").alias(c) for c in ("class", "n")],
        *[F.flatten(f"rows.{c}").alias(c) for c in ("venues", "members")],
        F.transform("rows", lambda r: F.size(r["members"])).alias("sizes"),
    )
    packed = _settled(packed, "similarity-blocks")
    blocks = packed.select("block")
    near = blocks.select(F.col("block").alias("l"), F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("r"))
    near = near.join(blocks.select(F.col("block").alias("r")), "r", "left_semi").select("l", "r")
    known = _settled(_ranked(_matched(near, packed, k).unionByName(_stars(classes, k)), k + 1), "similarity-known")
    last = known.where(F.col("rank") == k + 1).select("class", "score", "other")
    # A class with fewer entries takes any.
    weakest = classes.select("block", "class").join(last, "class", "left").groupBy("block").agg(
        F.min(F.coalesce("score", F.lit(-1))).alias("score"), F.max(F.coalesce("other", F.lit(-1))).alias("other")
    )
    rest = _matched(_settled(_openable(classes, weakest, near), "similarity-open"), packed, k)
    best = _ranked(known.select("class", "other", "shared", "union").unionByName(rest), k + 1)
    return members.join(best.drop("rank"), "class").where("artist != other").drop("class")


def top_similar(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k artists most similar to each artist, by score, then name: as `most_similar` over all pairs, ranked by each artist's task.

    All that artists meet are counted if that is at most `MET_PER_VISIT` for each visit. At crowded venues it is more, as it
    grows with the square of the crowd: blocks of artists then rule most pairs out.
    """
    sets = venue_sets(fact)
    met_at_all = _entries(sets)
    few = met_at_all <= MET_PER_VISIT * sets.visits.count()
    entries = _all_met(sets, met_at_all) if few else _best_of_blocks(sets, k)
    rank = F.row_number().over(Window.partitionBy("artist").orderBy(F.desc("score"), "other"))
    entries = entries.withColumn("similarity_rank", rank).where(F.col("similarity_rank") <= k)
    similar = sets.artists.select(F.col("artist").alias("other"), F.col("artist_name").alias("similar_artist"))
    return entries.join(sets.artists, "artist").join(similar, "other").select(
        "artist_name", "similar_artist", F.col("shared").alias("shared_venues"), F.round(F.col("shared") / F.col("union"), 4).alias("jaccard_similarity"), "similarity_rank"
    )


def other_side(artist: Column | str) -> Column:
    """The other artist of an undirected pair."""
    return F.when(F.col("artist_a") == artist, F.col("artist_b")).otherwise(F.col("artist_a"))


def similar_to(edges: DataFrame, artist: str, n: int = 10) -> DataFrame:
    """The artists most similar to one artist."""
    return (
        edges.where((F.col("artist_a") == artist) | (F.col("artist_b") == artist))
        .select(other_side(F.lit(artist)).alias("similar_artist"), "shared_venues", "jaccard_similarity")
        .orderBy(F.desc("jaccard_similarity"), "similar_artist")
        .limit(n)
    )


def most_similar(edges: DataFrame, n: int = 10) -> DataFrame:
    """`similar_to` for all artists at once; only n rows per artist leave a map task."""
    sides = F.array(
        F.struct(F.col("artist_a").alias("artist_name"), F.col("artist_b").alias("similar_artist")),
        F.struct(F.col("artist_b").alias("artist_name"), F.col("artist_a").alias("similar_artist")),
    )
    directed = edges.select(F.inline(sides), "shared_venues", "jaccard_similarity")
    rank = F.row_number().over(
        Window.partitionBy("artist_name").orderBy(F.desc("jaccard_similarity"), "similar_artist")
    )
    return directed.withColumn("similarity_rank", rank).where(F.col("similarity_rank") <= n)
