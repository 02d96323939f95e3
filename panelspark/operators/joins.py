"""Joins with explicit NULL and skew behaviour.

Only :func:`small_side` asks for a broadcast, after measuring. Elsewhere Spark broadcasts
a side whose known size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
both sides otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

_RIGHT = "__right__"

# Rows and characters (of the rows written out) up to which a frame is sent to all tasks.
SMALL_SIDE, SMALL_TEXT = 50_000, 8 << 20

# A key with more rows than PART_ROWS is dealt apart, up to HEAVY_KEYS of them.
PART_ROWS, HEAVY_KEYS = 1 << 17, 1000


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL matches NULL; each key appears once in the result."""
    # every right column gets its own name, so that joining two frames derived from
    # one table stays unambiguous
    renamed = right.select(*[F.col(c).alias(_RIGHT + c) for c in right.columns])
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_RIGHT + k)) for k in on]
    )
    joined = left.join(renamed, same, how)
    if how in ("left_anti", "left_semi"):
        return joined
    if how in ("right", "full"):
        keys = [F.coalesce(k, _RIGHT + k).alias(k) for k in on]
    else:
        keys = [F.col(k) for k in on]
    mine = [F.col(c) for c in left.columns if c not in on]
    theirs = [F.col(_RIGHT + c).alias(c) for c in right.columns if c not in on]
    return joined.select(*keys, *mine, *theirs)


def small_side(df: DataFrame, limit: int = SMALL_SIDE, text: int = SMALL_TEXT) -> DataFrame:
    """Marked for broadcast if it has few and short rows, else unchanged.

    Size estimates of derived frames are far too high, so Spark would shuffle the large
    side of a join with them. Here at most ``limit`` rows are fetched and measured, one
    at a time; a frame with more or longer ones is joined by shuffling both sides.
    """
    rows, held = [], 0
    for row in df.limit(limit + 1).toLocalIterator():
        held += len(repr(row))
        if len(rows) == limit or held > text:
            return df
        rows.append(row)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is listed; plain equality, so NULL keys never match."""
    return df.join(keys.select(*on), list(on), "left_semi")


def not_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed, NULL compared like a value."""
    return null_safe_join(df, keys.select(*on), on, "left_anti")


def enrich(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add lookup columns; exact duplicates in the lookup do not multiply rows."""
    return df.join(small_side(lookup.distinct()), list(on), "left")


def heavy_keys(
    df: DataFrame, on: Sequence[str], part_rows: int = PART_ROWS, most: int = HEAVY_KEYS
) -> DataFrame:
    """Hash ``__key`` and number of parts ``__parts`` of the keys with over ``part_rows`` rows.

    A sketch of the most frequent keys is kept per task and merged, without a shuffle of
    keys. It tracks ten times as many keys as it names, so that a key that it misses has
    less than one row in ``most``. At most ``most`` rows come out, whatever the input.
    """
    key = F.xxhash64(*[F.col(c) for c in on])
    hashed = df.select(key.alias("k"))
    top = hashed.agg(F.expr(f"approx_top_k(k, {most}, {10 * most})").alias("top"))
    found = top.select(F.explode("top").alias("t")).filter(F.col("t.count") > part_rows)
    parts = F.ceil(F.col("t.count") / part_rows).cast("int")
    return found.select(F.col("t.item").alias("__key"), parts.alias("__parts"))


def weighted_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Join in which each heavy key of ``big`` is dealt over tasks by its number of rows.

    The rows of a key with ``n`` rows go to ``n / part_rows`` parts by a hash of the whole
    row, and the rows of ``other`` with that key to each of these parts; all other rows are
    joined as they are. Every row of ``big`` meets all rows of its key, so that any join
    that keeps or drops rows of ``big`` stays whole.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of the other side would be repeated in a {how} join")
    heavy = F.broadcast(heavy_keys(big, on, part_rows))
    key = F.xxhash64(*[F.col(c) for c in on])
    row = F.xxhash64(*[F.col(c) for c in big.columns], F.lit(1))
    one = F.coalesce("__parts", F.lit(1))
    left = big.withColumn("__key", key).join(heavy, "__key", "left")
    left = left.withColumn("__part", F.pmod(row, one).cast("int")).drop("__key", "__parts")
    right = other.withColumn("__key", key).join(heavy, "__key", "left")
    right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), one - 1)))
    right = right.drop("__key", "__parts")
    keys = [*on, "__part"]
    met = null_safe_join(left, right, keys, how) if null_safe else left.join(right, keys, how)
    return met.drop("__part")


def lookup_right(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], part_rows: int = PART_ROWS
) -> DataFrame:
    """Every lookup row with the matching rows of ``df``, NULL matching NULL.

    Rows of ``df`` meet the lookup in an inner join that deals heavy keys apart; lookup rows
    that no key of ``df`` matches are added.
    """
    rest = [c for c in lookup.columns if c not in df.columns]
    met = weighted_join(df, lookup, on, null_safe=True, part_rows=part_rows)
    alone = not_matching(lookup, df.select(*on).distinct(), on)
    return met.select(*df.columns, *rest).unionByName(
        alone.select(*on, *rest), allowMissingColumns=True
    )


def salted_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    salts: int,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Inner or left join that splits each key of ``big`` over ``salts`` tasks.

    ``other`` is repeated once per salt, so it should be the smaller side per key.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting keeps only inner and left joins whole")
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts)).cast("int")
    left = big.withColumn("__salt", slot)
    slots = F.sequence(F.lit(0), F.lit(salts - 1))
    right = other.withColumn("__salt", F.explode(slots))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def cell_lookup(
    points: DataFrame, cells: DataFrame, on: Sequence[str], value: str
) -> DataFrame:
    """Value of the raster cell each point falls in, NULL off the raster."""
    return points.join(cells.select(*on, value), list(on), "left")
