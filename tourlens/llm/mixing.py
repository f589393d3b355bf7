"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of the words by weight, at most `most` times its own words; what a
full source leaves goes to the others by weight until none is above. Target over size is the number
of copies each document of the source is due. Whole copies are certain and come first. The rest of
the target is drawn without replacement: a document's inclusion probability grows with the
root of its size, so that few large documents fill the remainder closely, and documents are
ranked by the random odds divided by their inclusion odds (Rosen's Pareto order sampling). The sample
is the beginning of that order whose words come nearest to the target.

The random numbers are digests of source, id and seed: reruns agree on any cluster. The end of the
sample is found by histograms of the rank (two levels of 1,024 cells, summed before they are
shuffled), so no source is ever sorted in one task; only the documents of one cell are.

Defined cases: a null text has size 0; documents of size 0 are taken never (0 words). A null source
is a source of its own, last in order. Rows that repeat an id and size tie in rank; ties are broken by the
text's digest, and equal rows share one rank and are taken together. Null ids are ranked like others.
Extra columns are carried by `mix` and ignored otherwise; an existing column `copies` is replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourlens.llm.common import WORD, distilled, written

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Cells of a level of the histogram of ranks.
CELLS = 1024
#: Inclusion probability grows with size to this power.
POWER = 0.5


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row per source: source, source_size, target. `sizes` has a row per source: source, size.

    Sources fill up in the order of how much weight their limit is worth. The level is found at
    the first source that does not reach its limit. One row per source goes through one task here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1))
    limit = F.col("size") * most
    full_at = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_at.rowsBetween(0, Window.unboundedFollowing)
    levels = ranked.select(
        "source",
        "size",
        "weight",
        limit.alias("limit"),
        (F.sum("size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(onward).alias("weight_left"),
    )
    reached = F.col("limit") * F.col("weight_left") >= F.col("left") * F.col("weight")
    level = F.when(reached, F.col("left") / F.col("weight_left"))
    first = F.first(level, ignorenulls=True).over(full_at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("limit").cast("double"), F.col("weight") * first)
    return levels.select("source", F.col("size").alias("source_size"), F.coalesce(target, F.lit(0.0)).alias("target"))


def _uniform(key: Column, source: Column, seed: str) -> Column:
    """A number between 0 and 1, never either, from 52 bits of a digest."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(source, F.lit("")), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def allocation(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """A row per row: id, source, size, source_size, target, copies, and digest (of the text)."""
    sized = written(
        docs.select(
            F.col(key).alias("id"),
            F.col(source).alias("source"),
            words(F.col(text)).alias("size"),
            F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"),
        ),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("size"), F.sum(F.pow("size", F.lit(1 + POWER))).alias("powered")
    )
    totals = written(totals, "mix-sources")
    due = targets(totals.select("source", "size"), weights, most).alias("due")
    plan = written(
        due.join(totals, due["source"].eqNullSafe(totals["source"]))
        .select(due["source"].alias("of"), "source_size", "target", "powered")
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-plan",
    )
    rate = F.col("rest") / F.col("source_size")
    inclusion = F.least(F.pow("size", F.lit(POWER)) * F.col("rest") / F.col("powered"), F.lit(1 - 1e-9))
    odds = F.col("inclusion") / (1 - F.col("inclusion"))
    number = _uniform(F.col("id"), F.col("source"), seed)
    # Scaled by the source's own odds, ranks are spread over the cells at any rate.
    rank = number / (1 - number) / odds * F.least(rate, F.lit(0.999)) / (1 - F.least(rate, F.lit(0.999)))
    ranked = (
        sized.join(plan, sized["source"].eqNullSafe(plan["of"]), "left")
        .withColumn("drawn", (F.col("rest") >= 0.5) & (F.col("size") > 0))
        .withColumn("inclusion", F.when(F.col("drawn"), inclusion))
        .withColumn("rank", F.when(F.col("drawn"), rank / (1 + rank)))
        .withColumn("cell", F.floor(F.col("rank") * CELLS).cast("int"))
        .withColumn("part", F.floor((F.col("rank") * CELLS - F.col("cell")) * CELLS).cast("int"))
        .select("id", "source", "size", "digest", "source_size", "target", "whole", "rest", "rank", "cell", "part")
    )
    ranked = written(ranked, "mix-ranks")
    drawn = ranked.where("rank is not null")

    def crossing(cells: DataFrame, by: str) -> DataFrame:
        """The cell of each source in which its sum passes the rest of the target."""
        so_far = F.sum("words").over(Window.partitionBy("source").orderBy(by))
        return (
            cells.withColumn("after", so_far)
            .withColumn("begun", F.col("after") - F.col("words"))
            .where("begun < rest and after >= rest")
            .select(F.col("source").alias("of"), F.col(by).alias(f"{by}_end"), (F.col("rest") - F.col("begun")).alias("rest"))
        )

    coarse = drawn.groupBy("source", "rest", "cell").agg(F.sum("size").alias("words"))
    at_cell = written(crossing(coarse, "cell"), "mix-cells")
    inside = drawn.drop("rest").join(
        at_cell, drawn["source"].eqNullSafe(at_cell["of"]) & (F.col("cell") == F.col("cell_end"))
    )
    fine = inside.groupBy("source", "rest", "part").agg(F.sum("size").alias("words"))
    at_part = written(crossing(fine, "part"), "mix-parts")
    last = inside.drop("of", "rest").join(
        at_part, F.col("source").eqNullSafe(at_part["of"]) & (F.col("part") == F.col("part_end"))
    )
    # The few documents of the last cell one by one; the nearer side of the target wins.
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "id", "digest"))
    own = last.groupBy("source", "rest", "rank", "id", "digest").agg(F.sum("size").alias("size"))
    taken_last = (
        own.withColumn("after", so_far)
        .where("after - rest <= rest - (after - size)")
        .groupBy("source")
        .agg(F.max(F.struct("rank", "id", "digest")).alias("end"))
    )
    ends = (
        at_cell.join(at_part.select(F.col("of").alias("of2"), "part_end"), F.col("of").eqNullSafe(F.col("of2")), "left")
        .join(taken_last.select(F.col("source").alias("of3"), "end"), F.col("of").eqNullSafe(F.col("of3")), "left")
        .select(F.col("of"), "cell_end", "part_end", "end")
    )
    ends = written(ends, "mix-ends")
    before_cell = F.col("cell_end").isNull() | (F.col("cell") < F.col("cell_end"))
    in_cell = F.col("cell") == F.col("cell_end")
    before_part = in_cell & (F.col("part") < F.col("part_end"))
    in_part = in_cell & (F.col("part") == F.col("part_end"))
    to_end = in_part & (F.struct("rank", "id", "digest") <= F.col("end"))
    chosen = F.col("rank").isNotNull() & F.coalesce(before_cell | before_part | to_end, F.lit(False))
    return ranked.join(ends, ranked["source"].eqNullSafe(ends["of"]), "left").select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        (F.when(F.col("size") > 0, F.col("whole")).otherwise(0) + chosen.cast("int")).cast("int").alias("copies"),
        "digest",
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents that the mix takes, with `copies`, how often; rows come once."""

    def taken() -> DataFrame:
        takes = allocation(docs, key, text, source, **options).where("copies > 0")
        return takes.groupBy("id", "digest").agg(F.max("copies").alias("_copies"))

    takes = distilled(docs.sparkSession, "mix-takes", taken)
    rest = docs.drop("copies")
    same = rest[key].eqNullSafe(takes["id"]) & (
        F.md5(F.coalesce(rest[text], F.lit("")).cast("binary")) == takes["digest"]
    )
    return rest.join(takes, same).select(*[rest[c] for c in rest.columns], F.col("_copies").alias("copies"))
