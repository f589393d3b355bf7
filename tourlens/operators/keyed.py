"""One row per key, and joins on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, key: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by `order`, which should end in a total tie-breaker.

    Spark keeps only the best row per key in each map task before it shuffles
    (WindowGroupLimit), so a key that holds a large share of the rows is no burden.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, key: Sequence[str], at: str = "extracted_at", ties: Sequence[Column | str] = ()
) -> DataFrame:
    order = [F.col(at).desc_nulls_last(), *[F.col(t) if isinstance(t, str) else t for t in ties]]
    return best_per_key(df, key, order)


def lookup(
    rows: DataFrame, by: Column, table: DataFrame, key: str, spread: Column
) -> DataFrame:
    """Left join to a table that holds each key at most once.

    Rows without a key cannot match. Left as null they would all meet in one task, so they
    get a key of their own, made of `spread` and a prefix that no real key has.
    """
    rows = rows.withColumn("_by", F.coalesce(by, F.concat(F.lit("\x00"), spread)))
    if key in rows.columns:
        rows = rows.drop(key)
    return (
        rows
        .join(table.withColumnRenamed(key, "_by"), "_by", "left")
        .drop("_by")
    )
