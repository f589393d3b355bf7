"""Frozen result sets for readers without a cluster."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tourlens import schemas
from tourlens.functions import dates
from tourlens.plans import boards
from tourlens.sources import workspace
from tourlens.sources.tables import read_or_empty

META = "meta"


def normalise_dates(df: DataFrame) -> DataFrame:
    """Dates as timestamps; timestamps are UTC by the session's time zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema
        ]
    )


def snapshot_queries(
    table: Callable[[str], DataFrame], as_of: dt.date | Column | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The six exported result sets, whole; `table` reads a table by name."""
    return {
        "date_range": lambda: boards.upcoming_date_range(table("fact_concert"), as_of),
        "touring_intensity": lambda: table("mart_artist_touring_intensity"),
        "repertoire": lambda: boards.evolution_snapshot(table("mart_artist_yearly_repertoire")),
        "freshness": lambda: boards.evolution_snapshot(table("mart_artist_setlist_freshness")),
        "similarity": lambda: table("spark_artist_similarity").select(*boards.PAIR),
        "live_events": lambda: table("live_event_updates"),
    }


def export_snapshots(
    spark: SparkSession,
    table: Callable[[str], DataFrame],
    out_dir: str,
    as_of: dt.date | Column | None = None,
) -> dict[str, str]:
    """Write each result set to `<out_dir>/<name>`, then the export date.

    A set whose table cannot be read is skipped and its old copy removed, so that readers
    never mix days. Returns what became of each set.
    """
    outcome = {}
    for name, query in snapshot_queries(table, as_of).items():
        path = f"{out_dir}/{name}"
        try:
            normalise_dates(query()).write.mode("overwrite").parquet(path)
            outcome[name] = "exported"
        except (AnalysisException, LookupError) as problem:
            workspace.delete(spark, path)
            outcome[name] = f"skipped ({type(problem).__name__})"
    meta = spark.range(1).select(dates.day(as_of).alias("exported_date"))
    meta.write.mode("overwrite").parquet(f"{out_dir}/{META}")
    return outcome


def is_fresh(spark: SparkSession, out_dir: str, today: dt.date | Column | None = None) -> bool:
    """Were the snapshots exported today?"""
    meta = read_or_empty(spark, f"{out_dir}/{META}", schemas.SNAPSHOT_META)
    return bool(meta.where(F.col("exported_date") == dates.day(today)).take(1))
