"""Annual reports and news posts: ingest and upsert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators.ingest import status_log, unfetched_flagged, version_actions
from ..operators.posts import aggregate_posts, flatten_posts
from ..sources.tables import Tables

STATUS = "annual_reports_status"
LOG = "annual_reports_ingest_status_log"
FETCHED = "annual_reports_fetched"
KEYS = ["report", "country_iso3c", "report_year", "report_semester"]
POSTS = "posts"
POST_COUNTS = "post_counts"


def ingest_annual(
    tables: Tables,
    listing: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    parsed: Callable[[DataFrame], dict[str, DataFrame]],
    url_format: str,
    url_args: list[str],
    seed: int = 0,
) -> DataFrame:
    """Store the listing, fetch what is missing in random order, log and upsert."""
    stored = tables.overwrite(listing, STATUS)
    wanted = unfetched_flagged(
        stored, tables.read_if_exists(LOG), KEYS, url_format, url_args, seed
    )
    got = tables.overwrite(responses(wanted), FETCHED)
    log = status_log(wanted.select(*KEYS).join(got.select(*KEYS, "ingest_status"), KEYS, "left"))
    for name, table in parsed(got).items():
        by_disease = name.endswith("diseases_unmatched")
        key = "disease" if by_disease else "report"
        tables.upsert(name, table, [key], one_row_per_key=by_disease)
    return tables.upsert(LOG, log, ["report"])


def update_posts(
    tables: Tables, posts: DataFrame, url_prefix: str, version: str
) -> DataFrame:
    """Insert new posts and rewrite those flattened by another version."""
    actions = version_actions(posts, tables.read_if_exists(POSTS), "post_id", version)
    wanted = actions.filter(F.col("action") != "skip").drop("action")
    return tables.upsert(POSTS, flatten_posts(wanted, url_prefix, version), ["post_id"])


def update_post_counts(tables: Tables, posts: DataFrame) -> DataFrame:
    """Counts per disease, country and year over all posts."""
    return tables.overwrite(aggregate_posts(posts), POST_COUNTS)
