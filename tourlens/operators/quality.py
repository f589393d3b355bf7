"""Data checks. A check is a frame of violating rows; an empty one passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tourlens.functions import dates
from tourlens.plans.core import ARTIST_TYPES

# How far ahead a concert may be, and when a source counts as stale.
MAX_YEARS_AHEAD = 3
WARN_DAYS, ERROR_DAYS = 3, 7
SOURCES = ("ticketmaster", "setlistfm")


class CheckFailed(Exception):
    """A check between two stages found violations."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def not_accepted(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(not_accepted(column, values))


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column))
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def is_too_far_ahead(as_of: dt.date | Column | None = None) -> Column:
    return F.col("event_date") > F.add_months(dates.day(as_of), 12 * MAX_YEARS_AHEAD)


def too_far_ahead(fact: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    return fact.where(is_too_far_ahead(as_of))


def invalid_artist_types(dim: DataFrame, raw_artists: DataFrame) -> DataFrame:
    """Artists in the dimension of whom some raw record has a type that is not a performer's."""
    typed = raw_artists.where(
        F.col("artist_type").isNotNull() & ~F.col("artist_type").isin(*ARTIST_TYPES)
    )
    return dim.join(typed.select("mbid", "artist_type"), "mbid")


def future_rows(raw_events: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """How many raw events lie ahead. A figure to report, not a gate: most of them do."""
    ahead = dates.iso_date(F.col("event_date")) > dates.day(as_of)
    return raw_events.agg(F.count_if(ahead).alias("invalid_rows"))


def freshness(
    raw: Mapping[str, DataFrame], now: dt.datetime | Column | None = None
) -> DataFrame:
    """Newest extraction of each source, and whether that is too long ago."""
    reports = [
        df.agg(F.max("extracted_at").cast("timestamp").alias("latest")).withColumn("source_table", F.lit(t))
        for t, df in raw.items()
    ]
    at = dates.moment(now)
    latest = F.col("latest")

    def older(days: int) -> Column:
        return latest.isNull() | (latest < at - F.make_interval(days=F.lit(days)))

    status = F.when(older(ERROR_DAYS), "error").when(older(WARN_DAYS), "warn").otherwise("pass")
    return _union(reports).select("source_table", "latest", status.alias("status"))


@dataclass(frozen=True)
class Declared:
    """A table with its declared rules."""

    df: DataFrame
    required: Sequence[str] = ()
    keys: Sequence[str] = ()
    # Name of a check to the condition of a violating row.
    rows: Mapping[str, Column] = field(default_factory=dict)

    def row_rules(self) -> dict[str, Column]:
        return {f"{c}.not_null": F.col(c).isNull() for c in self.required} | dict(self.rows)


def raw_rules(raw: Mapping[str, DataFrame]) -> dict[str, Declared]:
    return {
        "raw_events": Declared(raw["ticketmaster_events"], ["event_id"], ["event_id"]),
        "raw_setlists": Declared(raw["setlistfm_setlists"], ["setlist_id"], ["setlist_id"]),
        "raw_artists": Declared(raw["musicbrainz_artists"], ["mbid"]),
    }


def staging_rules(stg_events: DataFrame, stg_setlists: DataFrame) -> dict[str, Declared]:
    return {
        "stg_events": Declared(stg_events, ["concert_id", "event_date", "country"], ["concert_id"]),
        "stg_setlists": Declared(
            stg_setlists, ["setlist_id", "event_date", "artist_name"], ["setlist_id"]
        ),
    }


def dim_rules(dim: DataFrame) -> dict[str, Declared]:
    return {"dim_artist": Declared(dim, ["artist_id", "mbid", "artist_name"], ["artist_id", "mbid"])}


def fact_rules(fact: DataFrame, as_of: dt.date | Column | None = None) -> dict[str, Declared]:
    return {
        "fact_concert": Declared(
            fact,
            ["concert_id", "event_date"],
            ["concert_id"],
            {
                "source.accepted_values": not_accepted("source", SOURCES),
                "event_date.too_far_ahead": is_too_far_ahead(as_of),
            },
        ),
    }


def declared_rules(
    raw: Mapping[str, DataFrame],
    stg_events: DataFrame,
    stg_setlists: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    as_of: dt.date | Column | None = None,
) -> dict[str, Declared]:
    staged = staging_rules(stg_events, stg_setlists)
    return raw_rules(raw) | staged | dim_rules(dim) | fact_rules(fact, as_of)


def dim_checks(raw: Mapping[str, DataFrame], dim: DataFrame) -> dict[str, DataFrame]:
    return {"dim_artist.artist_type.invalid": invalid_artist_types(dim, raw["musicbrainz_artists"])}


def fact_checks(dim: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    return {"fact_concert.artist_id.relationship": relationship(fact, "artist_id", dim, "artist_id")}


def _across_tables(
    raw: Mapping[str, DataFrame], dim: DataFrame, fact: DataFrame
) -> dict[str, DataFrame]:
    return fact_checks(dim, fact) | dim_checks(raw, dim)


def core_checks(
    raw: Mapping[str, DataFrame],
    stg_events: DataFrame,
    stg_setlists: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    as_of: dt.date | Column | None = None,
) -> dict[str, DataFrame]:
    """All declared checks of the warehouse, by name, as frames of violating rows."""
    checks = {}
    for table, rules in declared_rules(raw, stg_events, stg_setlists, dim, fact, as_of).items():
        checks |= {f"{table}.{n}": rules.df.where(bad) for n, bad in rules.row_rules().items()}
        checks |= {f"{table}.{c}.unique": unique(rules.df, c) for c in rules.keys}
    return checks | _across_tables(raw, dim, fact)


def core_report(
    raw: Mapping[str, DataFrame],
    stg_events: DataFrame,
    stg_setlists: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    as_of: dt.date | Column | None = None,
) -> DataFrame:
    """Violations of every declared check; all row rules of a table in one pass over it."""
    declared = declared_rules(raw, stg_events, stg_setlists, dim, fact, as_of)
    return counted(declared, _across_tables(raw, dim, fact))


def counted(
    declared: Mapping[str, Declared], others: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per check: all row rules and unique keys of a table in one pass over it, then `others`."""
    counts = [count_violations(rules.df, table, rules.row_rules(), rules.keys) for table, rules in declared.items()]
    return _union([*counts, report(others)] if others else counts)


def count_violations(df: DataFrame, table: str, rules: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Violations of row rules and of unique keys, in one scan and one shuffle.

    Each row becomes one (key, value) for each key; the first also carries the row's violations. Map tasks add up rows of one value
    before the shuffle, so a value, or the lack of one, that fills a table is no burden.
    """
    broken = [F.coalesce(bad, F.lit(False)).cast("long").alias(f"r{i}") for i, bad in enumerate(rules.values())]
    places = [F.struct(F.lit(i).alias("key"), F.col(c).cast("string").alias("value")) for i, c in enumerate(keys)]
    rows = df.select(*broken, F.inline(F.array(*places or [F.struct(F.lit(0).alias("key"), F.lit(None).cast("string").alias("value"))])))
    met = rows.groupBy("key", "value").agg(F.count("*").alias("n"), *[F.sum(F.when(F.col("key") == 0, F.col(f"r{i}"))).alias(f"r{i}") for i in range(len(rules))])
    twice = F.col("value").isNotNull() & (F.col("n") > 1)
    found = {name: F.coalesce(F.sum(f"r{i}"), F.lit(0)) for i, name in enumerate(rules)}
    found |= {f"{c}.unique": F.count_if((F.col("key") == i) & twice) for i, c in enumerate(keys)}
    counts = [F.struct(F.lit(f"{table}.{name}").alias("check_name"), n.alias("violations")) for name, n in found.items()]
    return met.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations."""
    return _union(
        [
            bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")
            for name, bad in checks.items()
        ]
    )


def gate(checks: Mapping[str, DataFrame]) -> None:
    """Stop the build at the first failing check, in the given order."""
    for name, bad in checks.items():
        example = bad.take(1)
        if example:
            raise CheckFailed(f"{name}: {example[0]}")


def gate_report(checks: DataFrame) -> None:
    """Stop the build if a counted check found violations; names all that did, in one job."""
    failed = checks.where("violations > 0").orderBy("check_name").collect()  # a row per check
    if failed:
        raise CheckFailed(", ".join(f"{r.check_name}: {r.violations}" for r in failed))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
