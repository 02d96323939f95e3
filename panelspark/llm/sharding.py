"""Shards of equal bytes by histogram sort.

The rows are ordered by a long key, ties by a hash of the row and of its place. To cut this order into
shards, the exact bytes below candidate boundaries are counted over all partitions.
Candidates are key prefixes: each round adds bits to the prefixes in which a cut lies and
counts only their rows, until every cut is exact or within the tolerance. Then the rows
are exchanged once, and numbered within their part of the order.

What reaches the driver is a count per prefix of the parts that hold a cut, at most
``cuts * 2 ** bits`` rows a round.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from .base import stored

FIRST_BITS, NEXT_BITS = 12, 8
#: Rows that one task sorts after the exchange.
PART_ROWS = 4_000_000
LEAST_PARTS = 4
LOW, FULL = -(1 << 63), 1 << 64
#: Low bits of a tie, which tell rows apart that are equal in all columns.
COPIES = (1 << 24) - 1


@dataclass
class Cut:
    """Where a target lies: below ``prefix`` there are ``below`` bytes."""

    target: int
    below: int = 0
    prefix: int = 0
    key: int | None = None  # set once only the tie is left to be searched
    place: tuple[int, int] | None = None  # first position at or after the cut
    done: bool = False


def _unsigned(c: Column) -> Column:
    return c.bitwiseXOR(F.lit(LOW))


def _prefix(c: Column, bits: int) -> Column:
    return F.shiftrightunsigned(c, 64 - bits) if bits else F.lit(0).cast("long")


def _signed(n: int) -> int:
    return n - FULL if n >= 1 << 63 else n


def _counts(rows: DataFrame, col: str, bits: int, more: int, cuts: list[Cut]) -> dict:
    """Bytes and rows by (key or None, longer prefix) of the prefixes that hold a cut."""
    u = _unsigned(F.col(col))
    inside = rows.filter(_prefix(u, bits).isin(sorted({_signed(c.prefix) for c in cuts})))
    keys = sorted({c.key for c in cuts if c.key is not None})
    if keys:
        inside = inside.filter(F.col("key").isin(keys))
    of = F.col("key") if keys else F.lit(None).cast("long")
    counted = inside.groupBy(of.alias("of"), _prefix(u, bits + more).alias("p")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    out: dict = {}
    for r in counted.collect():
        out.setdefault((r["of"], (r["p"] % FULL) >> more), []).append(
            (r["p"] % FULL, r["bytes"], r["n"])
        )
    return out


def _descend(rows: DataFrame, col: str, cuts: list[Cut], tolerance: float) -> None:
    bits = 0
    while bits < 64 and (open_ := [c for c in cuts if not c.done]):
        more = min(64 - bits, NEXT_BITS if bits else FIRST_BITS)
        counts = _counts(rows, col, bits, more, open_)
        for c in open_:
            for p, size, n in sorted(counts[(c.key, c.prefix)]):
                if c.below + size >= c.target:
                    break
                c.below += size
            c.prefix = p
            over = c.below + size - c.target
            if n == 1 or over <= tolerance:
                c.done, c.place = True, _start(p + 1, bits + more, c.key)
            elif c.target - c.below <= tolerance:
                c.done, c.place = True, _start(p, bits + more, c.key)
        bits += more


def _start(prefix: int, bits: int, key: int | None) -> tuple[int, int] | None:
    """First position of a prefix; None if it is beyond all positions."""
    at = prefix << (64 - bits)
    if key is not None:
        return (key, at + LOW) if at < FULL else _after(key)
    return (at + LOW, LOW) if at < FULL else None


def _after(key: int) -> tuple[int, int] | None:
    return (key + 1, LOW) if key < (1 << 63) - 1 else None


def find_cuts(rows: DataFrame, targets: list[int], tolerance: float = 0) -> list:
    """Positions ``(key, tie)`` that cut the order of ``rows`` at the target bytes.

    ``rows`` has the longs ``key``, ``tie`` and ``size``. A row lies before a cut if the
    bytes of all rows before it are below the target. Rows equal in key and tie are not
    told apart and stay together.
    """
    cuts = [Cut(t) for t in targets]
    _descend(rows, "key", cuts, tolerance)
    tied = [c for c in cuts if not c.done]
    for c in tied:
        c.key, c.prefix = _signed(c.prefix) ^ LOW, 0
    if tied:
        _descend(rows, "tie", tied, tolerance)
        for c in tied:
            if not c.done:
                c.place = _start(c.prefix + 1, 64, c.key)
    return [c.place for c in cuts]


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _passed(cuts: Column) -> Column:
    key, tie = F.col("__key"), F.col("__tie")
    return F.size(
        F.filter(cuts, lambda c: (c["k"] < key) | ((c["k"] == key) & (c["t"] <= tie)))
    )


def shard(
    df: DataFrame,
    key: str,
    size: Column,
    n_shards: int = 16,
    tolerance: float = 0,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards - 1``) and ``slot`` (gapless from 0).

    Shards are consecutive ranges of ``key`` (a long; null sorts first) whose sizes come
    as near to equal as whole rows allow; ``tolerance`` is the part of a shard's size by
    which a cut may miss. ``size`` is a row's bytes, null or negative counts as 0. Text
    keys are ordered by their hash. Rows with one key are ordered, and cut, by a hash of all
    their columns, and rows equal in every column by their place in the table, so that a
    row that is repeated any number of times is cut like others. With fewer rows than
    shards some shards are empty; an empty table gives no rows. Columns named ``shard`` or
    ``slot`` are replaced. The rows are written once, as places are only good there.
    """
    df = df.drop("shard", "slot")
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(COPIES)
    whole_row = F.xxhash64(*[df[c] for c in df.columns]).bitwiseAND(~COPIES)
    text = isinstance(df.schema[key].dataType, StringType)
    number = F.xxhash64(key) if text else F.col(key).cast("long")
    rows = stored(
        df.withColumn("__size", F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)))
        .withColumn("__key", F.when(F.col(key).isNull(), F.lit(LOW)).otherwise(number))
        .withColumn("__tie", whole_row.bitwiseOR(place)),
        "rows",
    )
    narrow = rows.select(*[F.col(f"__{c}").alias(c) for c in ("key", "tie", "size")])
    whole = narrow.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")
    ).first()
    per = max(LEAST_PARTS, math.ceil(whole["n"] / n_shards / part_rows))
    parts, total = n_shards * per, whole["bytes"]
    targets = [-(-total * i // parts) for i in range(1, parts)]
    cuts = find_cuts(narrow, targets, tolerance * total / n_shards) if total else [None] * (parts - 1)
    at = [{"k": c[0], "t": c[1]} if c else None for c in cuts]
    outer = [c for c in at[per - 1 :: per] if c]
    inner = [[c for c in at[i * per : i * per + per - 1] if c] for i in range(n_shards)]
    kind = "array<struct<k:bigint,t:bigint>>"

    def parted(frame: DataFrame) -> DataFrame:
        frame = frame.withColumn("shard", _passed(_literal(outer, kind)))
        own = F.element_at(_literal(inner, f"array<{kind}>"), F.col("shard") + 1)
        return frame.withColumn("__part", F.col("shard") * per + _passed(own))

    held = {
        r["__part"]: r["n"]
        for r in parted(narrow.toDF("__key", "__tie", "__size"))
        .groupBy("__part")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    first = [
        sum(held.get(j, 0) for j in range(p - p % per, p)) for p in range(parts)
    ]
    order = Window.partitionBy("__part").orderBy("__key", "__tie")
    return (
        parted(rows)
        .withColumn(
            "slot",
            F.element_at(_literal(first, "array<bigint>"), F.col("__part") + 1)
            + F.row_number().over(order)
            - 1,
        )
        .select(*[F.col(c) for c in df.columns], "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; every part of a shard's range becomes a file of it."""
    sharded.write.partitionBy("shard").parquet(path)
