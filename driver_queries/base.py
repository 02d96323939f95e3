"""Registry of queries over the driver tables, each with the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelspark.session import scratch_dir
from panelspark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Data:
    """The driver tables of one scale, and a fresh folder for written tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table  # file listing and schema are read once per query
        return table

    def scratch(self) -> str:
        return scratch_dir(self.spark, "query")

    def tables(self) -> Tables:
        return Tables(self.spark, self.scratch())

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that is used more than once: written once, then read."""
        kept = self.__dict__.setdefault("kept", {})
        if name not in kept:
            kept[name] = self.tables().overwrite(make(), name)
        return kept[name]


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# -- derived inputs shared by several queries, with their SQL ------------------------

FLOWS_SQL = """
flows AS (
  SELECT sn.n_name AS country_origin, cn.n_name AS country_destination,
         CAST(extract(year FROM l_shipdate) AS INTEGER) AS year,
         l_quantity, l_discount, l_extendedprice, l_partkey, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey)
"""


def nation_of(d: Data, key: str, name: str) -> DataFrame:
    return d.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


def flows(d: Data) -> DataFrame:
    """Line items as shipments from a supplier's to a customer's nation.

    Orders take the customer's nation key first, so that line items are shuffled by
    order once; the fixed nation table is joined last, on small integer keys.
    """
    buyers = d.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    sellers = d.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    orders = (
        d.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        .join(buyers, "o_custkey")
        .drop("o_custkey")
    )
    return (
        d.lineitem.join(orders, "l_orderkey")
        .join(sellers, "l_suppkey")
        .join(nation_of(d, "s_nationkey", "country_origin"), "s_nationkey")
        .join(nation_of(d, "c_nationkey", "country_destination"), "c_nationkey")
        .select(
            "country_origin",
            "country_destination",
            F.year("l_shipdate").alias("year"),
            "l_quantity",
            "l_discount",
            "l_extendedprice",
            "l_partkey",
            "l_shipdate",
        )
    )


# Orders as half-year reports of a customer's nation: segment as disease, priority as
# taxa, order status as population. Cheap orders stand for reported cases, dear ones for
# predicted cases, so both are missing where a cell has no such order.
CELLS_SQL = """
predictions AS (
  SELECT n_name AS country_iso3c, lower(c_mktsegment) AS disease,
         CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
         CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS report_semester,
         o_orderpriority AS taxa, o_orderstatus AS disease_population,
         CAST(sum(CASE WHEN o_totalprice < 200000 THEN 1 END) AS DOUBLE) AS cases,
         CAST(sum(CASE WHEN o_totalprice > 400000 THEN 1
                       WHEN o_totalprice > 100000 THEN 0 END) AS DOUBLE) AS predicted_cases,
         bool_or(CASE WHEN o_totalprice < 200000 THEN o_totalprice < 100000 END)
           AS disease_status,
         bool_and(CASE WHEN o_totalprice > 50000 THEN o_totalprice >= 200000 END)
           AS disease_status_unreported
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)
"""


def reports(d: Data) -> DataFrame:
    """Orders with the half-year report keys."""
    buyers = d.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
    )
    first_half = F.month("o_orderdate") < 7
    placed = d.orders.join(buyers, "o_custkey")
    return placed.join(nation_of(d, "c_nationkey", "country_iso3c"), "c_nationkey").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_totalprice",
        "country_iso3c",
        F.lower("c_mktsegment").alias("disease"),
        F.year("o_orderdate").alias("report_year"),
        F.when(first_half, 1).otherwise(2).alias("report_semester"),
        F.col("o_orderpriority").alias("taxa"),
        F.col("o_orderstatus").alias("disease_population"),
    )


def predictions(d: Data) -> DataFrame:
    price = F.col("o_totalprice")
    cheap = price < 200000
    return (
        reports(d)
        .groupBy(
            "country_iso3c",
            "disease",
            "report_year",
            "report_semester",
            "taxa",
            "disease_population",
        )
        .agg(
            F.sum(F.when(cheap, 1)).cast("double").alias("cases"),
            F.sum(F.when(price > 400000, 1).when(price > 100000, 0))
            .cast("double")
            .alias("predicted_cases"),
            F.bool_or(F.when(cheap, price < 100000)).alias("disease_status"),
            F.bool_and(F.when(price > 50000, price >= 200000)).alias(
                "disease_status_unreported"
            ),
        )
    )


def rounded(c: str | Column, digits: int) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
