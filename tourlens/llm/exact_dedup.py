"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after each run of ASCII white space became one space.
The first level counts texts by their length, the second counts hashes of the beginning among
lengths that repeat, and only rows whose length and beginning repeat have their whole content
hashed. Each level is a count with map-side combine, so a group with a third of all rows costs
a row per task; the rows are tied to a level by joins that Spark can split.

Defined cases: a null text is an empty one, and empty texts equal each other. A null id is never
the smallest unless the group has no other; then all rows of the group stay. Rows that repeat an
id and its text are one document given several times: they stay or go together, and each counts
in the size of the group. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import distilled, written

#: Code points whose hash is the second level.
PREFIX = 64


def normalised(text: Column) -> Column:
    """Each run of white space as one space; a single space needs no replacement."""
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*", " "
    )


def full_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def repeated_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """Texts that occur more than once: text_sha256, keep_id (the smallest id), group_size."""
    content = docs.select(F.col(key).alias("id"), normalised(F.col(text)).alias("content"))
    content = content.select(
        "id",
        "content",
        F.octet_length("content").alias("length"),
        F.xxhash64(F.substring("content", 1, prefix)).alias("beginning"),
    )
    shapes = written(content.select("length", "beginning"), "dedup-shapes")
    lengths = written(shapes.groupBy("length").count().where("count > 1").select("length"), "dedup-lengths")
    beginnings = written(
        shapes.join(lengths, "length", "left_semi")
        .groupBy("length", "beginning")
        .count()
        .where("count > 1")
        .select("length", "beginning"),
        "dedup-beginnings",
    )
    survivors = content.join(beginnings, ["length", "beginning"], "left_semi")
    return written(
        survivors.select("id", full_hash(F.col("content")).alias("text_sha256"))
        .groupBy("text_sha256")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "dedup-groups",
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """A row per row: the id, text_sha256, keep_id, group_size and whether the row stays."""
    groups = repeated_texts(docs, key, text, prefix)
    rows = docs.select(F.col(key), full_hash(normalised(F.col(text))).alias("text_sha256"))
    joined = rows.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col(key)).otherwise(F.col("keep_id"))
    return joined.select(
        key,
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col(key).eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without later copies, all columns as they came.

    Only ids of copies are carried to the last join. An id with several texts goes if each is a copy; rows
    without an id stay.
    """

    def copies() -> DataFrame:
        copy = ~F.col(key).eqNullSafe(F.col("keep_id"))
        ids = exact_groups(docs.select(key, text), key, text).groupBy(F.col(key).alias("_id"))
        return ids.agg(F.min(copy).alias("all")).where("all").select("_id")

    gone = distilled(docs.sparkSession, "dedup-gone", copies)
    return docs.join(gone, docs[key] == gone["_id"], "left_anti")
