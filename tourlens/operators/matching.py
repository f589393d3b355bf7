"""Resolve artist names to canonical records, and verify what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens import schemas
from tourlens.functions import dates, text
from tourlens.operators.keyed import best_per_key
from tourlens.plans.core import ARTIST_TYPES
from tourlens.sources.tables import typed_empty, with_columns_of

# When another result casts a shadow over the match (long enough name, well
# enough known, clearly better known).
SHADOW_LETTERS = 4
SHADOW_TAGS = 10
SHADOW_LEAD = 3

# Entries written by an older shape of the cache are resolved again.
CACHE_VERSION = 1


def _candidates() -> Column:
    """The search results with rank, match key and number of tags.

    A search is one landed document, so matching runs inside each row, over all results it
    holds: no result table, self join or shuffle.
    """
    results = F.col("artists")
    keys = text.normalise_names(F.transform(results, lambda a: a["name"]))
    ranked = F.transform(results, lambda a, rank: F.struct(a.alias("record"), rank.alias("rank")))
    return F.zip_with(
        ranked,
        keys,
        lambda a, key: F.struct(
            a["record"].alias("record"),
            a["rank"].alias("rank"),
            key.alias("key"),
            F.coalesce(F.size(a["record"]["tags"]), F.lit(0)).alias("tag_count"),
        ),
    )


def _first(candidates: Column, test) -> Column:
    return F.get(F.filter(candidates, test), F.lit(0))


def match_searches(searches: DataFrame, *more: str) -> DataFrame:
    """One row per search with the matched result, or null where none is trustworthy, and `more` columns.

    An equal normalised name beats one that merely starts with the searched name; within
    each, the better rank wins. The searched name must not be the longer one. A match is
    dropped when its name contains that of a much better known result: it is then most
    likely a cover act named after the original.
    """
    searched = searches.withColumns(
        {
            "search_key": text.normalise_name(text.strip_qualifier(F.col("searched_name"))),
            "candidates": _candidates(),
        }
    )
    key = F.col("search_key")
    found = searched.withColumn(
        "best",
        F.when(
            key != "",
            F.coalesce(
                _first(F.col("candidates"), lambda c: c["key"] == key),
                _first(F.col("candidates"), lambda c: c["key"].startswith(key)),
            ),
        ),
    )
    best = F.col("best")
    shadowed = F.exists(
        "candidates",
        lambda other: (other["rank"] != best["rank"])
        & (F.length(other["key"]) >= SHADOW_LETTERS)
        & best["key"].contains(other["key"])
        & (other["tag_count"] >= SHADOW_TAGS)
        & (other["tag_count"] >= best["tag_count"] + SHADOW_LEAD),
    )
    match = F.when(~F.coalesce(shadowed, F.lit(False)), best["record"])
    return found.select("searched_name", match.alias("match"), *more)


def ranked_tags(tags: Column) -> Column:
    """Tag names by votes, the earlier first among equals; null names stay in place."""
    votes = F.transform(
        tags,
        lambda t, pos: F.struct(
            (-F.coalesce(t["count"], F.lit(0))).alias("votes"), pos.alias("pos"), t["name"].alias("name")
        ),
    )
    return F.transform(F.array_sort(votes), lambda t: t["name"])


def _record(name: Column, match: Column) -> list[Column]:
    names = ranked_tags(match["tags"])
    return [
        text.cache_key(name).alias("cache_key"),
        name.alias("artist_name"),
        match["id"].alias("mbid"),
        match["country"].alias("origin_country"),
        dates.leading_year(match["life-span"]["begin"]).alias("formation_year"),
        match["type"].alias("artist_type"),
        F.get(names, F.lit(0)).alias("primary_genre"),
        F.coalesce(
            F.filter(names, lambda n: F.coalesce(n, F.lit("")) != ""), F.array().cast("array<string>")
        ).alias("genres"),
        match["disambiguation"].alias("disambiguation"),
        F.when(match.isNotNull(), F.coalesce(match["name"], F.lit(""))).alias("mb_name"),
        F.lit(CACHE_VERSION).alias("cache_version"),
    ]


def _one_per_name(df: DataFrame, name: str, *order: Column) -> DataFrame:
    keyed = df.withColumn("cache_key", text.cache_key(F.col(name)))
    return best_per_key(keyed, ["cache_key"], [*order, F.col(name).asc()])


def resolve_artists(names: DataFrame, searches: DataFrame, cache: DataFrame) -> DataFrame:
    """Resolve `names` (artist_name, optional position) from the cache or a search.

    `is_new` marks the records that the cache does not hold yet. A name that was searched
    without a match is a record too, with a null id, and is cached like the others. A name
    that is neither cached nor searched is left out, to be tried next time.
    """
    order = [F.col("position").asc()] if "position" in names.columns else []
    wanted = _one_per_name(names, "artist_name", *order).select("cache_key", "artist_name")
    known = with_columns_of(cache, schemas.ARTIST_RESOLUTION).where(
        F.col("cache_version") >= CACHE_VERSION
    )
    hits = wanted.select("cache_key").join(known, "cache_key")
    missing = wanted.join(known, "cache_key", "left_anti")
    # Matched where they are read: what is sorted, shuffled and joined is a record, not all results of a search.
    matched = match_searches(searches.withColumn("digest", F.xxhash64(F.to_json("artists"))), "digest")
    records = matched.select("searched_name", "digest", *_record(F.col("searched_name"), F.col("match")))
    chosen = _one_per_name(records, "searched_name", F.col("digest").asc()).drop("searched_name", "digest", "artist_name")
    fresh = missing.join(chosen, "cache_key").select(*typed_empty(cache.sparkSession, schemas.ARTIST_RESOLUTION).columns)
    found = hits.select(*fresh.columns).withColumn("is_new", F.lit(False))
    return found.unionByName(fresh.withColumn("is_new", F.lit(True)))


def new_cache_entries(resolved: DataFrame) -> DataFrame:
    return resolved.where("is_new").drop("is_new")


def verify_artists(resolved: DataFrame) -> DataFrame:
    """Add `reject_reason`: null for a verified artist.

    An unknown or empty type passes here; the dimension is stricter about empty ones.
    """
    kind = F.nullif(F.col("artist_type"), F.lit(""))
    return resolved.withColumn(
        "reject_reason",
        F.when(F.col("mbid").isNull() | (F.col("mbid") == ""), "no_mbid")
        .when(kind.isNotNull() & ~kind.isin(*ARTIST_TYPES), "artist_type")
        .when(text.mentions_tribute(F.col("disambiguation")), "tribute"),
    )


def verified(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNull())


def artist_rows(resolved: DataFrame, extracted_at: Column) -> DataFrame:
    """Raw artist rows. Rejected artists are kept here; the dimension sorts them out."""
    return resolved.where(F.col("mbid").isNotNull() & (F.col("mbid") != "")).select(
        "artist_name",
        "mbid",
        "origin_country",
        "formation_year",
        "artist_type",
        "primary_genre",
        extracted_at.alias("extracted_at"),
    )


def with_artist_id(events: DataFrame, artists: DataFrame) -> DataFrame:
    """Keep the events of verified artists and give them the artist's id."""
    ids = artists.select("cache_key", F.col("mbid").alias("verified_mbid"))
    return (
        events.withColumn("cache_key", text.cache_key(F.col("artist_name")))
        .join(ids, "cache_key")
        .withColumn("artist_mbid", F.col("verified_mbid"))
        .drop("cache_key", "verified_mbid")
    )


def existing_ids(raw_setlists: DataFrame) -> DataFrame:
    return raw_setlists.select("artist_mbid").where(F.col("artist_mbid").isNotNull()).distinct()


def without_setlists(artists: DataFrame, raw_setlists: DataFrame) -> DataFrame:
    """Artists of whom no setlist is stored yet."""
    stored = existing_ids(raw_setlists).withColumnRenamed("artist_mbid", "mbid")
    return artists.join(stored, "mbid", "left_anti")


def count_by_reason(judged: DataFrame, kept: str = "kept") -> DataFrame:
    """Run metrics: how many rows were kept or rejected, by reason."""
    return judged.groupBy(F.coalesce("reject_reason", F.lit(kept)).alias("outcome")).agg(
        F.count("*").alias("n")
    )
