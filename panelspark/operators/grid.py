"""Complete key grids.

A panel holds every combination of its keys, so its size is the product of the axes
whatever the method. Two axes are joined on a slot number, which spreads the product
evenly over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

def bounded_rows(df: DataFrame, limit: int) -> list | None:
    """The rows if there are at most ``limit``, else None; fetches ``limit + 1``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def product(base: DataFrame, axis: DataFrame, slots: int | None = None) -> DataFrame:
    """Every row of ``base`` with every row of ``axis``.

    Rows of ``base`` are dealt to slots, as many as the session has shuffle partitions,
    and the axis is repeated once per slot, so that the product is spread over all tasks
    whatever the sizes.
    """
    spark = base.sparkSession
    slots = slots or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    own = F.pmod(F.xxhash64(*[F.col(c) for c in base.columns]), F.lit(slots))
    left = base.withColumn("__slot", own.cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    return left.join(axis.withColumn("__slot", every), "__slot").drop("__slot")


def with_values(base: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every row of ``base`` with every listed value."""
    return base.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def with_years(base: DataFrame, first: int, last: int, name: str = "year") -> DataFrame:
    return base.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(last))))


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash a small key frame over all cores before it is expanded.

    The explicit number keeps adaptive execution from merging the still small
    partitions, and hashing an expression keeps Spark from dropping the step where the
    frame is partitioned by the same columns already; either would leave the whole
    expansion to few tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, F.xxhash64(*cols))


def ordered_pairs(
    countries: DataFrame,
    code: str = "country_iso3c",
    origin: str = "country_origin",
    destination: str = "country_destination",
) -> DataFrame:
    """Every ordered pair of different countries."""
    codes = countries.select(code).dropna().distinct()
    base = spread(codes.select(F.col(code).alias(origin)), origin)
    pairs = product(base, codes.select(F.col(code).alias(destination)))
    return pairs.filter(F.col(origin) != F.col(destination))


def add_codes(countries: DataFrame, extra: Sequence[str], code: str = "country_iso3c"):
    """Country list with hand-added territory codes."""
    spark: SparkSession = countries.sparkSession
    more = spark.createDataFrame([(c,) for c in extra], f"{code} string")
    return countries.select(code).unionByName(more).dropna().distinct()
