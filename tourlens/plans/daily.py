"""The daily build: ingest, then dimension, fact, marts and similarity, each behind a check of what it reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from tourlens.operators import quality
from tourlens.plans import core, marts, similarity, staging
from tourlens.plans.ingest import Ingested
from tourlens.plans.ingest import write as write_raw
from tourlens.sources.tables import RAW_TABLES, TableStore


def raw_tables(store: TableStore) -> dict[str, DataFrame]:
    return {name: store.read(name) for name in RAW_TABLES}


def staged_concerts(raw: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    events = staging.stg_events(raw["ticketmaster_events"], raw["musicbrainz_artists"])
    return events, staging.stg_setlists(raw["setlistfm_setlists"])


def build_core(
    store: TableStore,
    loaded_at: dt.datetime | Column | None = None,
    full_refresh: bool = False,
    drop_called_off: bool = False,
    strict_reference: bool = False,
    as_of: dt.date | Column | None = None,
) -> None:
    """Dimension, then fact, from the stored raw tables; a failing check leaves both as they were.

    Raw and staged rows are checked first. Dimension and fact are written unseen, each is checked,
    and only then are both published with their watermarks. Each check is one job.
    """
    raw = raw_tables(store)
    how = {"full_refresh": full_refresh, "strict_reference": strict_reference}
    quality.gate_report(quality.counted(quality.raw_rules(raw) | quality.staging_rules(*staged_concerts(raw))))
    draft = store.draft()
    try:
        dim = core.load_dim_artist(draft, raw["musicbrainz_artists"], raw["ticketmaster_events"], loaded_at, **how)
        quality.gate_report(quality.counted(quality.dim_rules(dim), quality.dim_checks(raw, dim)))
        rows, taken = dict(raw), not (full_refresh or strict_reference)
        if taken:
            rows["ticketmaster_events"], rows["setlistfm_setlists"] = core.due_concerts(
                store, raw["ticketmaster_events"], raw["setlistfm_setlists"]
            )
        removed = core.called_off(raw["ticketmaster_events"]) if drop_called_off else None
        unified = staging.concerts_unified(*staged_concerts(rows))
        fact = core.load_fact_concert(draft, unified, dim, loaded_at, removed=removed, taken=taken, **how)
        quality.gate_report(quality.counted(quality.fact_rules(fact, as_of), quality.fact_checks(dim, fact)))
    except BaseException:
        draft.discard()
        raise
    draft.publish()


def checks(store: TableStore, as_of: dt.date | Column | None = None) -> dict[str, DataFrame]:
    raw = raw_tables(store)
    return quality.core_checks(
        raw, *staged_concerts(raw), store.read("dim_artist"), store.read("fact_concert"), as_of
    )


def build_marts(store: TableStore, as_of: dt.date | Column | None = None) -> None:
    """Store the marts and the similarity table. Each is written once and not counted again."""
    fact, dim = store.read("fact_concert"), store.read("dim_artist")
    store.overwrite("mart_artist_touring_intensity", marts.touring_intensity(fact, dim, as_of))
    store.overwrite("mart_artist_yearly_repertoire", marts.yearly_repertoire(fact, dim))
    store.overwrite("mart_artist_setlist_freshness", marts.setlist_freshness(fact, dim))
    store.overwrite("spark_artist_similarity", similarity.venue_similarity(fact))


def run(
    store: TableStore,
    ingested: Ingested | None = None,
    as_of: dt.date | Column | None = None,
    loaded_at: dt.datetime | Column | None = None,
    full_refresh: bool = False,
) -> None:
    """All stages in order; the first failing check stops what follows."""
    if ingested is not None:
        write_raw(store, ingested)
    build_core(store, loaded_at, full_refresh, as_of=as_of)
    build_marts(store, as_of)
