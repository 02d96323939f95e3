"""Duplicate handling and table invariants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import not_matching, small_side


def duplicated_reports(
    df: DataFrame, group: Sequence[str], report: str
) -> DataFrame:
    """Report ids that are not the first of some group they appear in.

    Reports are numbered by id. The first id per group is an aggregate, and the
    comparison joins on group and id together, so a large group is spread by id.
    """
    seen = df.select(*group, report).distinct()
    first = seen.groupBy(*group).agg(F.min(report).alias(report))
    return not_matching(seen, first, [*group, report]).select(report).distinct()


def drop_duplicated_reports(
    df: DataFrame, group: Sequence[str], report: str
) -> DataFrame:
    """Remove every row of a report that repeats an earlier report of its group.

    Repeated reports are rare, so the wide rows are normally filtered without a shuffle.
    """
    repeated = small_side(duplicated_reports(df, group, report))
    return not_matching(df, repeated, [report])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First row of each key in a total order; ties fall to the other columns."""
    rest = [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order, *rest)
    return (
        df.withColumn("__rank", F.row_number().over(ranked))
        .filter("__rank = 1")
        .drop("__rank")
    )


def drop_all_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows, less every key that still has more than one row.

    A key has a single distinct row exactly if its smallest and largest row agree.
    Both are combined before the one shuffle, so a key with very many rows costs one
    partial row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    ends = df.groupBy(*keys).agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"))
    single = ends.filter(F.col("__lo").eqNullSafe(F.col("__hi")))
    return single.select(*keys, "__lo.*").select(*df.columns)


def key_problems(df: DataFrame, keys: Sequence[str], nullable: bool = False) -> DataFrame:
    """Keys that are repeated or have a missing part, with their row count.

    With ``nullable`` a missing part is a value like any other.
    """
    missing = F.lit(False)
    for k in [] if nullable else keys:
        missing = missing | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | missing)


def require_unique(df: DataFrame, keys: Sequence[str], nullable: bool = False) -> None:
    bad = key_problems(df, keys, nullable).head(1)
    if bad:
        raise ValueError(f"key {list(keys)} is not unique and complete: {bad[0]}")


def require_row_count(df: DataFrame, expected: int) -> None:
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, found {found}")


def require_any_new(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> None:
    if not not_matching(new, existing, key).head(1):
        raise ValueError(f"no new {list(key)} among the incoming rows")


def invariants(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the row count, the number of keys and how many keys repeat."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated"),
    )
