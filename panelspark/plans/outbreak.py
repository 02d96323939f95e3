"""The daily outbreak run and the monthly re-score."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import surrogate_id
from ..operators.dedupe import drop_all_duplicates
from ..operators.ingest import FULL, any_good, classify_errors, run_mode, unfetched
from ..operators.network import (
    CELL,
    FLAGS,
    SUFFIX,
    affected_cells,
    combine_status,
    exposure,
    label_coefficients,
    month_status,
    predictions_by_origin,
    scale,
    score_logit,
)
from ..operators.joins import matching, not_matching, small_side
from ..operators.quarantine import KEY, clean_disease_names, preprocess_events
from ..operators.rollup import single_country
from ..sources.tables import Tables

LOG = "outbreak_reports_ingest_status_log"
EVENTS = "outbreak_reports_events"
OUTBREAKS = "outbreak_reports_outbreaks"
UNMATCHED = "outbreak_reports_diseases_unmatched"
PREDICTIONS = "network_lme_augment_predict"
BY_ORIGIN = "network_lme_augment_predict_by_origin"
COEFFICIENTS = "network_lme_coefficients"
SCALING = "network_lme_scaling_values"
REJECTED = "outbreak_reports_excluded"
FETCHED = "outbreak_reports_fetched"
BY_KEY = "outbreak_reports_events_by_key"
KEYS = "outbreak_reports_event_keys"
STATUS = "network_status"
CHANGED = "network_changed_status"
TOUCHED = "network_affected_cells"
CELLS = "network_cells_to_score"
ARRIVING = "network_arriving_by_origin"
SCORED = "network_newly_scored"
TAG = "model_tag"

REPORT = "report_id"
#: Scores of a disease and month depend on reports of all countries, and on no others.
GROUP = ("disease", "month")
EVENT_COLUMNS = (
    REPORT, *KEY, "is_aquatic", "start_date", "last_report_date", "resolved_date", "endemic",
)
OUTBREAK_KEY = ("report_id", "outbreak_location_id", "species_name")


def unique_outbreaks(outbreaks: DataFrame) -> DataFrame:
    """Outbreak rows with a display id, without keys that occur more than once."""
    single = drop_all_duplicates(outbreaks, OUTBREAK_KEY)
    return single.select(surrogate_id(*OUTBREAK_KEY).alias("id"), "*")


def ingest(
    tables: Tables,
    listing: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    parsed: Callable[[DataFrame], dict[str, DataFrame]],
    url_prefix: str,
) -> DataFrame | None:
    """Fetch what is missing, log it, and upsert the raw tables.

    ``responses`` fetches the requested reports (one row each); it is evaluated once and
    stored, so that the log and the tables describe the same fetch. ``parsed`` turns
    usable responses into the raw tables. Returns the new events, or None if nothing was
    usable.
    """
    key = "report_info_id"
    requested = unfetched(listing, tables.read_if_exists(LOG), key, url_prefix=url_prefix)
    got = tables.overwrite(responses(requested), FETCHED)
    log = classify_errors(requested, got, key)
    tables.upsert(LOG, log, [key], fill_missing=True)
    if not any_good(matching_log(tables, requested, key)):
        return None
    raw = parsed(got)
    tables.upsert(EVENTS, raw[EVENTS], [REPORT], fill_missing=True, changes=True)
    tables.upsert(
        OUTBREAKS,
        unique_outbreaks(raw[OUTBREAKS]),
        OUTBREAK_KEY,
        fill_missing=True,
        nullable_keys=True,
    )
    if UNMATCHED in raw:
        tables.upsert(UNMATCHED, raw[UNMATCHED].select("disease").distinct(), ["disease"])
    return raw[EVENTS]


def matching_log(tables: Tables, requested: DataFrame, key: str) -> DataFrame:
    return tables.read(LOG).join(requested.select(key), key, "left_semi")


def daily(
    tables: Tables,
    listing: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    parsed: Callable[[DataFrame], dict[str, DataFrame]],
    url_prefix: str,
    **model,
) -> DataFrame | None:
    """Ingest what is missing, then score what the new and corrected reports change.

    ``model`` are the arguments of :func:`score` after the events. The event table is read
    only in the buckets of the reports that came in.
    """
    new = ingest(tables, listing, responses, parsed, url_prefix)
    if new is None:
        return None
    before = tables.before(EVENTS)
    return score(tables, new, None, replaced=new.limit(0) if before is None else before, **model)


def _slice(
    tables: Tables, new: DataFrame, replaced: DataFrame, names: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Take new reports into the stored events and find what has to be scored again.

    Returns the raw keys and the (country, disease) keys whose months may differ now, the
    events of these keys, and the single-country flags of all diseases. Keys are those that
    the reports name now and those they named before, other raw names of the same disease
    in the same country, and all keys of a disease that came to a second country or is left
    in one only.
    """
    both = new.select(*KEY).unionByName(replaced.select(*KEY)).distinct()
    touched = small_side(both)
    groups = not_matching(tables.read_keys(BY_KEY, touched), new, [REPORT])
    earlier = tables.read(KEYS)
    tables.replace(BY_KEY, groups.unionByName(new.select(*EVENT_COLUMNS)), touched, KEY)
    live = tables.read_keys(BY_KEY, touched).filter(~F.col("is_aquatic")).select(*KEY).distinct()
    tables.replace(KEYS, live, touched, KEY)

    was = clean_disease_names(earlier, names).filter("disease IS NOT NULL")
    now = clean_disease_names(tables.read(KEYS), names).filter("disease IS NOT NULL")
    flags = single_country(now)
    old = single_country(was).withColumnRenamed("disease_in_single_country", "__was")
    turned = flags.join(old, "disease", "full").filter(
        ~F.col("disease_in_single_country").eqNullSafe(F.col("__was"))
    )
    every = was.unionByName(now)
    moved = every.join(turned.select("disease"), "disease", "left_semi").select(*KEY)
    standard = clean_disease_names(touched, names).filter("disease IS NOT NULL").select(*KEY)
    wanted = small_side(standard.unionByName(moved).distinct())
    named = every.join(wanted, list(KEY), "left_semi").select(
        "country_iso3c", F.col("disease_name_uncleaned").alias("disease")
    )
    raw = small_side(named.unionByName(both).distinct())
    return raw, wanted, tables.read_keys(BY_KEY, raw), flags


def score(
    tables: Tables,
    new_events: DataFrame | None,
    history: DataFrame | None,
    names: DataFrame,
    taxa: DataFrame,
    coefficients: DataFrame,
    scaling: DataFrame,
    edges: DataFrame,
    weights: Sequence[str],
    tag: str,
    as_of: dt.date,
    since: dt.date,
    full: bool | None = None,
    replaced: DataFrame | None = None,
) -> DataFrame:
    """Score changed rows, or everything after a model change, and store the results.

    Every known country and disease has a row for each month from ``since`` to
    ``as_of``, in outbreak or not, so a month that is no longer active is a changed row.
    ``history`` is the event table as it was before ``new_events`` were stored; without
    it the stored one is taken. Without new events all of it is scored again, which is the
    monthly run that carries open outbreaks on to the current month.

    An incremental run reads the stored events of the keys that the new reports and the
    versions they replaced (``replaced``, else looked up in ``history``) name, scores the
    changed months and those of countries that they have an edge to, and takes out the
    cells of keys that no report names any more. It gives what a full run would give.
    """
    cached = tables.read_if_exists(PREDICTIONS)
    if full is None:
        full = new_events is None or run_mode(cached, TAG, tag) == FULL
    full = full or not tables.exists(BY_KEY)
    variables = [f"{w}{SUFFIX}" for w in weights]
    columns = [*CELL, *FLAGS]

    if full:
        events = tables.read(EVENTS) if history is None else history
        if new_events is not None:
            # a corrected report replaces what it said before
            events = not_matching(events, new_events, [REPORT]).select(*EVENT_COLUMNS)
            events = events.unionByName(new_events.select(*EVENT_COLUMNS))
        events = tables.overwrite(events.select(*EVENT_COLUMNS), BY_KEY, by=KEY)
        live = events.filter(~F.col("is_aquatic")).select(*KEY).distinct()
        tables.overwrite(live, KEYS, by=KEY)
        flags = None
    else:
        if replaced is None:
            replaced = matching(history, new_events, [REPORT])
        raw, wanted, events, flags = _slice(tables, new_events, replaced, names)

    def expand(events: DataFrame) -> DataFrame:
        return month_status(events, as_of, since, carried=["disease_name_uncleaned"])

    rows, rejected = preprocess_events(
        events,
        None,
        names,
        taxa,
        coefficients.select("disease").distinct(),
        expand,
        full=True,
        columns=columns,
        combine=combine_status,
        single=flags,
    )
    # every output starts from the stored status rows instead of re-reading the events
    if full:
        cells = status = tables.overwrite(rows, STATUS, by=KEY, unique=CELL)
    else:
        before = tables.read_keys(STATUS, wanted)
        tables.replace(STATUS, rows, wanted, KEY, unique=CELL)
        after = tables.read_keys(STATUS, wanted)
        changed = after.subtract(before.select(*columns)).withColumn("gone", F.lit(False))
        gone = before.join(after, list(CELL), "left_anti").withColumn("gone", F.lit(True))
        changed = tables.overwrite(changed.unionByName(gone), CHANGED)
        touched = tables.overwrite(affected_cells(changed, edges), TOUCHED)
        # sources and destinations of a changed cell share its disease and month
        groups = touched.select(*GROUP).distinct()
        kept = tables.read_keys(PREDICTIONS, groups).select(*columns)
        kept = kept.join(changed, list(CELL), "left_anti")
        status = kept.unionByName(changed.filter("NOT gone").drop("gone"))
        cells = tables.overwrite(status.join(touched, list(CELL), "left_semi"), CELLS)

    years = cells.select(F.year("month").alias("year")).distinct()
    arriving = exposure(status, edges.join(years, "year", "left_semi"), weights, False)
    joined = cells.join(arriving, list(CELL), "left").fillna(0.0, variables)
    by_origin = tables.overwrite(joined, ARRIVING)

    totals = by_origin.groupBy(*CELL, *FLAGS).agg(*[F.sum(v).alias(v) for v in variables])
    scored = score_logit(scale(totals, scaling, variables), coefficients, variables)
    scored = scored.withColumn(TAG, F.lit(tag))
    scored = scored.select(surrogate_id(*CELL).alias("id"), "*")
    unique = (*CELL, "country_origin")
    reject_key = ["country_iso3c", "disease_name_uncleaned"]
    if full:
        scored = tables.overwrite(scored, PREDICTIONS, by=GROUP, unique=CELL)
        origins = predictions_by_origin(by_origin, scored)
        tables.overwrite(origins, BY_ORIGIN, by=GROUP, unique=unique, nullable_keys=True)
        tables.overwrite(rejected, REJECTED, by=reject_key)
    else:
        scored = tables.overwrite(scored, SCORED)
        origins = predictions_by_origin(by_origin, scored)
        tables.replace(
            BY_ORIGIN, origins, touched, CELL, by=GROUP, unique=unique, nullable_keys=True
        )
        scored = tables.replace(PREDICTIONS, scored, touched, CELL, by=GROUP, unique=CELL)
        raw = raw.withColumnRenamed("disease", "disease_name_uncleaned")
        tables.replace(REJECTED, rejected, raw, reject_key)
    tables.overwrite(label_coefficients(coefficients), COEFFICIENTS)
    tables.overwrite(scaling, SCALING)
    return scored
