"""Deciding what to fetch, logging what came back, and what it changes."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import matching, not_matching, small_side
from ..functions.text import contains
from ..session import stored

# Texts that mark a response as failed, and the fetch states of the log.
INGESTION_ERROR = "ingestion error"
TIMED_OUT = "Endpoint request timed out"
FAILED_TO_FETCH = "failed to fetch"
AVAILABLE = "available"

# Rows that one task numbers.
SLICE_ROWS = 4_000_000

FULL = "full"
INCREMENTAL = "incremental"
NO_TAG = "dne"


def unfetched(
    listing: DataFrame,
    log: DataFrame | None,
    key: str,
    error_col: str = "ingest_error",
    url_prefix: str | None = None,
    url_suffix: str = "",
) -> DataFrame:
    """Listed reports without a logged success; failures are tried again."""
    out = listing
    if log is not None:
        kind = listing.schema[key].dataType
        done = log.filter(~F.col(error_col)).select(F.col(key).try_cast(kind).alias(key))
        out = not_matching(listing, done, [key])
    if url_prefix is not None:
        url = F.concat(F.lit(url_prefix), F.col(key).cast("string"), F.lit(url_suffix))
        out = out.withColumn("url", url)
    return out


def unfetched_flagged(
    listing: DataFrame,
    log: DataFrame | None,
    keys: Sequence[str],
    url_format: str | None = None,
    url_args: Sequence[str] = (),
    seed: int | None = None,
) -> DataFrame:
    """Reported items not yet flagged ``in_database``, optionally in random order."""
    if log is None:
        out = listing.withColumn("in_database", F.lit(False))
    else:
        flags = log.select(*keys, "in_database")
        out = listing.join(flags, list(keys), "left").withColumn(
            "in_database", F.coalesce("in_database", F.lit(False))
        )
    out = out.filter(F.col("reported") & ~F.col("in_database"))
    if url_format is not None:
        out = out.withColumn("url", F.format_string(url_format, *url_args))
    return out if seed is None else out.orderBy(F.rand(seed))


def failed(status: str = "ingest_status", message: str = "message") -> Column:
    return contains(status, INGESTION_ERROR) | contains(message, TIMED_OUT)


def classify_errors(
    requested: DataFrame,
    responses: DataFrame,
    key: str,
    status: str = "ingest_status",
    message: str = "message",
) -> DataFrame:
    """Log row per requested report with its ``ingest_error`` flag."""
    flags = responses.select(key, failed(status, message).alias("ingest_error"))
    return requested.join(flags, key)


def status_log(responses: DataFrame, status: str = "ingest_status") -> DataFrame:
    """``in_database`` and the error text per response; none means a failed fetch."""
    state = F.coalesce(status, F.lit(FAILED_TO_FETCH))
    ok = state == AVAILABLE
    return responses.select(
        *[c for c in responses.columns if c != status],
        ok.alias("in_database"),
        F.when(~ok, state).alias("ingest_error"),
    )


def parse_report_name(name: str | Column) -> list[Column]:
    """Country, year, semester and report key from ``ISO_YYYY_semS``-style names."""
    name = F.col(name) if isinstance(name, str) else name
    iso, year, sem = (F.substring(name, a, n) for a, n in ((1, 3), (5, 4), (13, 1)))
    year, sem = year.try_cast("int"), sem.try_cast("int")
    return [
        F.concat_ws("_", iso, year.cast("string"), sem.cast("string")).alias("report"),
        iso.alias("country_iso3c"),
        year.alias("report_year"),
        sem.alias("report_semester"),
    ]


def row_positions(
    df: DataFrame, order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """1-based position in a global order, without a single-task sort.

    The rows are evaluated once, into files; everything after reads these. They are cut
    into ranges of the whole order, so rows that share its leading value can be cut apart.
    Positions are counted within ranges and shifted by the sizes of the ranges before. Any
    cuts give the same positions; only balance varies.
    """
    spark = df.sparkSession
    kept = stored(df, "unordered")
    if slices is None:
        cores = spark.sparkContext.defaultParallelism
        slices = max(4 * cores, math.ceil(kept.count() / SLICE_ROWS))
    ranged = kept.repartitionByRange(slices, *order).withColumn("__slice", F.spark_partition_id())
    ranges = stored(ranged, "ranges")
    sizes = {r[0]: r[1] for r in ranges.groupBy("__slice").count().collect()}
    before, total = [], 0
    for i in range(slices + 1):
        before.append(total)
        total += sizes.get(i, 0)
    offset = F.element_at(
        F.from_json(F.lit(json.dumps(before)), "array<bigint>"), F.col("__slice") + 1
    )
    within = Window.partitionBy("__slice").orderBy(*order)
    return ranges.withColumn(name, F.row_number().over(within) + offset).drop("__slice")


def assign_batches(
    df: DataFrame, order: Sequence[str], size: int, name: str = "batch"
) -> DataFrame:
    """0-based batch number of ``size`` consecutive rows in the given order."""
    out = row_positions(df, order, "__position")
    batch = F.floor((F.col("__position") - 1) / F.lit(size))
    return out.withColumn(name, batch).drop("__position")


def any_good(log: DataFrame, error_col: str = "ingest_error") -> bool:
    """Whether any response is usable."""
    return bool(log.filter(~F.col(error_col)).head(1))


def run_mode(cached: DataFrame | None, tag_col: str, tag: str) -> str:
    """Full recompute unless every cached row was scored with the current model."""
    if cached is None:
        known = [NO_TAG]
    else:
        known = [r[0] for r in cached.select(tag_col).distinct().limit(2).collect()]
    return INCREMENTAL if known == [tag] else FULL


def history_for(new: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows with the full history of just the keys they touch.

    New rows are few next to the history, which is then filtered without a shuffle.
    """
    touched = small_side(new.select(*keys).distinct())
    return matching(history, touched, keys).unionByName(new, allowMissingColumns=True)


def changed_rows(
    new: DataFrame, cache: DataFrame, touched: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Distinct new rows the cache does not hold, comparing the new columns only."""
    return new.subtract(matching(cache, touched, keys).select(*new.columns))


def version_actions(
    documents: DataFrame,
    stored: DataFrame | None,
    key: str,
    version: str,
    version_col: str = "update_script_version",
) -> DataFrame:
    """``insert``, ``update`` or ``skip`` per document by its stored version."""
    if stored is None:
        return documents.withColumn("action", F.lit("insert"))
    held = stored.select(
        key, F.col(version_col).alias("__version"), F.lit(True).alias("__held")
    )
    same = F.col("__version").eqNullSafe(F.lit(version))
    action = (
        F.when(F.col("__held").isNull(), F.lit("insert"))
        .when(~same, F.lit("update"))
        .otherwise(F.lit("skip"))
    )
    joined = documents.join(held, key, "left").withColumn("action", action)
    return joined.drop("__version", "__held")
