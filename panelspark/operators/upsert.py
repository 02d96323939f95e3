"""Keyed upsert as a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import not_matching


def align_columns(
    target: DataFrame, updates: DataFrame, fill_missing: bool
) -> tuple[DataFrame, DataFrame]:
    """Give both sides the same columns, new ones as text, in the target's types."""
    if not fill_missing and set(target.columns) != set(updates.columns):
        odd = sorted(set(target.columns) ^ set(updates.columns))
        raise ValueError(f"columns differ: {odd}")
    for c in updates.columns:
        if c not in target.columns:
            target = target.withColumn(c, F.lit(None).cast("string"))
    typed = []
    for f in target.schema:
        value = F.col(f.name) if f.name in updates.columns else F.lit(None)
        typed.append(value.cast(f.dataType).alias(f.name))
    return target, updates.select(*typed)


def merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    fill_missing: bool = False,
) -> DataFrame:
    """Target rows whose key is not updated, plus every update as a whole row.

    A column the updates lack becomes NULL in replaced rows.
    """
    target, updates = align_columns(target, updates, fill_missing)
    return not_matching(target, updates, keys).unionByName(updates)
