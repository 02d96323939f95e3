"""The weekly half-year run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import surrogate_id
from ..operators.dedupe import drop_duplicated_reports, first_per_key, require_any_new
from ..operators.ingest import any_good, classify_errors, unfetched
from ..operators.panel import append_absent
from ..operators.quarantine import UNRECOGNIZED, clean_disease_names
from ..operators.rollup import nowcast_summary
from ..session import stored
from ..sources.tables import Tables

LOG = "six_month_reports_ingest_status_log"
SUMMARY = "six_month_reports_summary"
DETAIL = "six_month_reports_detail"
UNMATCHED = "six_month_reports_diseases_unmatched"
FETCHED = "six_month_reports_fetched"
PREDICTIONS = "nowcast_boost_augment_predict"
ROLLUP = "nowcast_boost_predict_oie_diseases"

GROUP = ("country_iso3c", "report_year", "report_semester")
ITEM = ("disease", "disease_population", "taxa")
SUMMARY_KEY = (*GROUP, *ITEM, "serotype", "control_measures")
ROLLUP_KEY = ("country_iso3c", "disease", "report_year", "report_semester")
DETAIL_KEY = (*GROUP, *ITEM, "serotype", "adm", "period")


def with_id(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(surrogate_id(*key).alias("id"), "*")


def clean_summary(summary: DataFrame) -> DataFrame:
    return with_id(drop_duplicated_reports(summary, GROUP, "report_id"), SUMMARY_KEY)


def clean_detail(detail: DataFrame) -> DataFrame:
    kept = drop_duplicated_reports(detail, GROUP, "report_id")
    return with_id(first_per_key(kept, DETAIL_KEY, ["report_id"]), DETAIL_KEY)


def ingest(
    tables: Tables,
    listing: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    parsed: Callable[[DataFrame], dict[str, DataFrame]],
    url_prefix: str,
    url_suffix: str = "",
) -> DataFrame | None:
    """Fetch what is missing, log it, clean and upsert; returns the stored summary."""
    requested = unfetched(
        listing,
        tables.read_if_exists(LOG),
        "report_id",
        url_prefix=url_prefix,
        url_suffix=url_suffix,
    )
    got = tables.overwrite(responses(requested), FETCHED)
    log = classify_errors(requested, got, "report_id")
    tables.upsert(LOG, log, ["report_id"], fill_missing=True)
    now = tables.read(LOG).join(requested.select("report_id"), "report_id", "left_semi")
    if not any_good(now):
        return None
    raw = parsed(got)
    stored = tables.upsert(
        SUMMARY, clean_summary(raw[SUMMARY]), SUMMARY_KEY, fill_missing=True, nullable_keys=True
    )
    tables.upsert(
        DETAIL, clean_detail(raw[DETAIL]), DETAIL_KEY, fill_missing=True, nullable_keys=True
    )
    if UNMATCHED in raw:
        tables.upsert(UNMATCHED, raw[UNMATCHED].select("disease").distinct(), ["disease"])
    return stored


def preprocess(
    new: DataFrame, existing: DataFrame | None, names: DataFrame, key: str = "id"
) -> tuple[DataFrame | None, DataFrame]:
    """(rows to score, rejected keys) from new and stored half-year reports.

    At least one new row must have a ``key`` that is not stored, else ``ValueError``.
    Aquatic rows, and rows that do not say, leave first. Disease names are replaced by
    their standard ones; items of an unknown disease are rejected with the reason. Every
    remaining item gets an ``unreported`` row for each country and half-year without one,
    two half-years into the future. None where no row remains.
    """
    rows = new
    if existing is not None:
        require_any_new(new, existing, [key])
        rows = existing.unionByName(new, allowMissingColumns=True)
    cleaned = clean_disease_names(rows.filter(~F.col("is_aquatic")), names)
    lookup = cleaned.select(*GROUP, "disease", "disease_population", "disease_name_uncleaned")
    unknown = lookup.filter("disease IS NULL").distinct()
    rejected = unknown.withColumn("reason_for_exclusion", F.lit(UNRECOGNIZED))
    known = stored(cleaned.filter("disease IS NOT NULL"), "half-years")
    return (None if known.isEmpty() else append_absent(known)), rejected


def store_predictions(
    tables: Tables, predictions: DataFrame, diseases: Sequence[str], tags: dict[str, str]
) -> DataFrame:
    """Replace the cached predictions and their roll-up.

    A version whose key is not unique is never published.
    """
    tagged = predictions
    for name, tag in tags.items():
        tagged = tagged.withColumn(name, F.lit(tag))
    key = [*GROUP, *ITEM]
    stored = tables.overwrite(with_id(tagged, key), PREDICTIONS, unique=key, nullable_keys=True)
    return tables.overwrite(
        nowcast_summary(stored, diseases), ROLLUP, unique=ROLLUP_KEY, nullable_keys=True
    )
