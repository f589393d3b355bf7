"""Connected components of an undirected graph by alternating star contractions.

Large stars tie each vertex's larger neighbours to its smallest neighbour, small stars its smaller ones;
both keep components and shrink every component to a star around its smallest vertex in a few rounds.
Minima are aggregated with map-side combine and joined back, so a vertex with very many edges is no
single task's work. Each half round is written to the shared folder: nothing is recomputed after a loss. The number of
edges is known in every round and sets the number of tasks.

Defined cases: repeated edges, loops and both directions of an edge are allowed; edges with a null end are ignored;
no edges give no rows. Vertices without edges are not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import written

#: Edges of a task.
EDGES = 250_000


def components(edges: DataFrame) -> DataFrame:
    """`edges` has columns a and b; a row per vertex: vertex, component (its smallest vertex)."""
    now = edges.where("a is not null and b is not null and a <> b")
    now = written(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    tasks = 1 + now.count() // EDGES

    def kept(df: DataFrame, name: str) -> DataFrame:
        return written(df.coalesce(tasks), f"cc-{name}")

    while True:
        least = kept(now.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        # Stars already: every vertex has one smaller neighbour, which has none itself.
        centres = least.select(F.col("m").alias("a")).distinct()
        if least.where("n > 1").isEmpty() and least.join(centres, "a", "left_semi").isEmpty():
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(large.where("a <> b").distinct(), "large")
        least = kept(now.groupBy("a").agg(F.min("b").alias("m")), "least")
        tied = now.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = tied.union(least.select("a", F.col("m").alias("b")))
        now = kept(small.where("a <> b").distinct(), "small")
    rim = least.select(F.col("a").alias("vertex"), F.col("m").alias("component"))
    return kept(rim.union(rim.select("component", "component").distinct()), "components")
