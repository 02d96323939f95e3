"""Cleaning disease names and setting aside rows that cannot be scored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from .ingest import changed_rows, history_for
from .joins import lookup_right, matching, not_matching, small_side
from .rollup import single_country

# Reasons for exclusion, in the order the checks run.
UNRECOGNIZED = "unrecognized disease"
NOT_PRIMARY_TAXA = "disease not in primary taxa"
SINGLE_COUNTRY = "disease in single country"
NOT_IN_MODEL = "disease not represented in model"

KEY = ("country_iso3c", "disease")
REJECT_COLUMNS = ("country_iso3c", "disease_name_uncleaned", "disease")


def clean_disease_names(
    df: DataFrame, names: DataFrame, disease: str = "disease"
) -> DataFrame:
    """Standard name by lookup; the raw name stays as ``disease_name_uncleaned``.

    ``names`` has ``disease_name`` and ``disease_standard``; case and outer blanks do
    not matter. An unknown name becomes NULL.
    """
    spelled = F.lower(F.trim("disease_name"))
    known = names.select(
        spelled.alias("__name"), F.col("disease_standard").alias("__standard")
    ).distinct()
    known = small_side(known)
    raw = df.withColumn("disease_name_uncleaned", F.col(disease))
    raw = raw.withColumn("__name", F.lower(F.trim("disease_name_uncleaned")))
    joined = raw.join(known, "__name", "left")
    rest = [c for c in df.columns if c != disease]
    return joined.select(
        *rest, F.col("__standard").alias(disease), "disease_name_uncleaned"
    )


def _rejects(df: DataFrame, reason: str) -> DataFrame:
    return (
        df.select(*REJECT_COLUMNS)
        .distinct()
        .withColumn("reason_for_exclusion", F.lit(reason))
    )


def split_unrecognized(lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned, rejected) of a lookup after :func:`clean_disease_names`."""
    unknown = F.col("disease").isNull()
    return lookup.filter(~unknown), _rejects(lookup.filter(unknown), UNRECOGNIZED)


def split_unmodelled(
    processed: DataFrame, model_diseases: DataFrame, full: bool
) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by primary taxa, single country (full runs) and model.

    A row with an unknown taxa flag leaves without a reason, as it does on filtering.
    """
    primary = F.col("disease_primary_taxa")
    rejected = _rejects(processed.filter(~primary), NOT_PRIMARY_TAXA)
    kept = processed.filter(primary).drop("disease_primary_taxa")
    if full:
        single = F.col("disease_in_single_country")
        rejected = rejected.unionByName(_rejects(kept.filter(single), SINGLE_COUNTRY))
        kept = kept.filter(~single)
    modelled = small_side(model_diseases.select("disease").distinct())
    outside = not_matching(kept, modelled, ["disease"])
    rejected = rejected.unionByName(_rejects(outside, NOT_IN_MODEL))
    return matching(kept, modelled, ["disease"]), rejected


def preprocess_events(
    new: DataFrame | None,
    history: DataFrame | None,
    names: DataFrame,
    taxa: DataFrame,
    model_diseases: DataFrame,
    expand,
    cache: DataFrame | None = None,
    full: bool = False,
    columns: Sequence[str] | None = None,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    single: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows to score, rejected keys) from new events and stored history.

    ``expand`` turns cleaned events into monthly status rows; ``taxa`` holds the
    ``disease_primary_taxa`` flag per standard disease. An incremental run reads the
    history of touched keys only and keeps rows that differ from ``cache``. Raw names
    that share a standard name give several rows per month; ``combine`` makes one.
    ``single`` has the flags of diseases in a single country where ``new`` and ``history``
    are only a part of all events.
    """
    if full:
        parts = [p for p in (history, new) if p is not None]
        events = parts[0] if len(parts) == 1 else parts[0].unionByName(
            parts[1], allowMissingColumns=True
        )
        events = events.filter(~F.col("is_aquatic"))
        touched = events.select(*KEY).distinct()
    else:
        if history is None:
            raise ValueError("an incremental run needs stored events")
        touched = small_side(new.select(*KEY).distinct())
        events = history_for(new, history, KEY).filter(~F.col("is_aquatic"))

    lookup, unrecognized = split_unrecognized(clean_disease_names(touched, names))
    events = clean_disease_names(events, names).filter(F.col("disease").isNotNull())

    # both lookups have a row per disease; joined by shuffling, a common disease would
    # gather in one task
    processed = expand(events).join(small_side(taxa), "disease", "left")
    on = [*KEY, "disease_name_uncleaned"]
    if full:
        flags = small_side(single_country(events) if single is None else single)
        processed = processed.join(flags, "disease", "left")
    else:
        processed = lookup_right(processed, lookup, on)
    kept, rejected = split_unmodelled(processed, model_diseases, full)
    if full:
        kept = kept.drop("disease_in_single_country")
    if columns is not None:
        kept = kept.select(*columns)
    if combine is not None:
        kept = combine(kept)
    if not full and cache is not None:
        keys = small_side(lookup.select(*KEY).distinct())
        kept = changed_rows(kept, cache, keys, KEY)
    return kept, unrecognized.unionByName(rejected)
