"""Reconciliation checks and schema inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ingest import FAILED_TO_FETCH
from .joins import null_safe_join
from .rollup import OUTBREAK_MEASURES, event_totals, period_totals

DISEASE_KEYS = ("country_iso3c", "report_year", "disease", "serotype")


def schema_table(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Table, position, column and type of every column, as rows."""
    rows = [
        (table, i, f.name, f.dataType.simpleString(), f.nullable)
        for table, df in frames.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    spark: SparkSession = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(
        rows,
        "table_name string, ordinal_position int, column_name string, "
        "data_type string, is_nullable boolean",
    )


def known_counts(df: DataFrame) -> DataFrame:
    """Known values per column, in one row from one pass."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def drop_empty_cols(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    counts = known_counts(df).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def field_check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Columns on one side only; no rows means the schemas agree."""
    on = ["table_name", "column_name"]
    actual, expected = actual.select(*on), expected.select(*on)
    missing = expected.join(actual, on, "left_anti").withColumn(
        "problem", F.lit("in schema, not in database")
    )
    extra = actual.join(expected, on, "left_anti").withColumn(
        "problem", F.lit("in database, not in schema")
    )
    return missing.unionByName(extra)


def reported_vs_calculated(
    detail: DataFrame,
    reported: DataFrame,
    keys: Sequence[str] = ("id", "species"),
    measures: Sequence[str] = OUTBREAK_MEASURES,
) -> DataFrame:
    """Totals that differ from the reported ones where both are known.

    The wide rows are joined once per key and turned long afterwards.
    """
    calculated = event_totals(detail, keys, measures)
    joined = null_safe_join(
        calculated, reported.select(*keys, *[f"total_{m}" for m in measures]), keys
    )
    pairs = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).cast("double").alias("value_calculated"),
            F.col(f"total_{m}").try_cast("double").alias("value_reported"),
        )
        for m in measures
    ]
    long = joined.select(*keys, F.inline(F.array(*pairs)))
    return long.filter("value_calculated <> value_reported")


def outbreaks_by_period_check(
    df: DataFrame,
    keys: Sequence[str] = DISEASE_KEYS,
    period: str = "report_months",
) -> DataFrame:
    """Years whose new outbreaks differ from, or whose total exceeds, their halves."""
    measures = {
        "new_outbreaks": ("sum_new_outbreaks_sem", "new_outbreaks_ann"),
        "total_outbreaks": ("sum_total_outbreaks_sem", "total_outbreaks_ann"),
    }
    joined = period_totals(df, keys, measures, period)
    checked = joined.withColumns(
        {
            "total_outbreak_check": F.col("sum_total_outbreaks_sem")
            >= F.col("total_outbreaks_ann"),
            "new_outbreak_check": F.col("sum_new_outbreaks_sem")
            == F.col("new_outbreaks_ann"),
        }
    )
    return checked.filter(~F.col("total_outbreak_check") | ~F.col("new_outbreak_check"))


def cases_by_period_check(
    df: DataFrame,
    keys: Sequence[str] = (*DISEASE_KEYS, "taxa"),
    period: str = "report_months",
) -> DataFrame:
    """Years with more cases than their halves together."""
    joined = period_totals(df, keys, {"cases": ("sum_cases_sem", "cases_ann")}, period)
    checked = joined.withColumn(
        "cases_check", F.col("sum_cases_sem") >= F.col("cases_ann")
    )
    return checked.filter(~F.col("cases_check"))


def new_above_total(df: DataFrame) -> DataFrame:
    """Rows with more new than total outbreaks."""
    return df.dropna(subset=["new_outbreaks", "total_outbreaks"]).filter(
        "new_outbreaks > total_outbreaks"
    )


def unexpected_errors(log: DataFrame) -> DataFrame:
    """Items not in the database for another reason than a failed fetch."""
    return log.filter(~F.col("in_database")).filter(
        ~F.col("ingest_error").contains(FAILED_TO_FETCH)
    )


def ingestion_errors(log: DataFrame) -> DataFrame:
    return log.filter(F.col("ingest_error").contains("ingestion error:"))


def missing_first_report(events: DataFrame, column: str = "immediate_report") -> DataFrame:
    return events.filter(F.col(column).isNull())


def all_missing(log: DataFrame, listing: DataFrame) -> DataFrame:
    """Items that failed to arrive and items never reported, in one table."""
    absent = log.filter(~F.col("in_database"))
    keys = [c for c in listing.columns if c in log.columns]
    unreported = listing.filter(~F.col("reported")).select(*keys, "reported")
    return absent.unionByName(unreported, allowMissingColumns=True)
