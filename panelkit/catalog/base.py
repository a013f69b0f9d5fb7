"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL twin if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def yyyymmdd(column: str):
    return F.date_format(column, "yyyyMMdd").cast("long")


def cents(price: str):
    """A price in whole cents: sums of them are exact in any order."""
    return F.round(F.col(price) * 100).cast("long")


CENTS_SQL = "CAST(round(l_extendedprice * 100) AS BIGINT)"

# The order priorities stand in for period types; the last one is no known type.
TYPE_OF_PRIORITY = {
    "1-URGENT": "MAT/ 52 we",
    "2-HIGH": "2MAT/ 104 we",
    "3-MEDIUM": "3MMT/ 12we",
    "4-NOT SPECIFIED": "Monthly",
    "5-LOW": "Weekly",
}
TYPE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'MAT/ 52 we' WHEN '2-HIGH' THEN '2MAT/ 104 we'
    WHEN '3-MEDIUM' THEN '3MMT/ 12we' WHEN '4-NOT SPECIFIED' THEN 'Monthly' ELSE 'Weekly' END"""

DURATION_OF_PRIORITY = {
    "1-URGENT": 12,
    "2-HIGH": 24,
    "3-MEDIUM": 3,
    "4-NOT SPECIFIED": 1,
    "5-LOW": 1,
}
DURATION_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 12 WHEN '2-HIGH' THEN 24
    WHEN '3-MEDIUM' THEN 3 ELSE 1 END"""
HEAD_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'MAT' WHEN '2-HIGH' THEN '2MATs'
    WHEN '3-MEDIUM' THEN '3MMT' ELSE 'Month' END"""
NEW_TYPE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'MAT/ 52 we' WHEN '2-HIGH' THEN '2MATs/ 104 we'
    WHEN '3-MEDIUM' THEN '3MMT/ 12we' ELSE 'Month' END"""
