"""Named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name; a trailing underscore avoids an import."""

    def register(fn: Query) -> Query:
        name = fn.__name__.rstrip("_")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of files.

    The braces make the path a pattern: under a plain one Spark's stream takes no single file.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def r6(c: Column | str) -> Column:
    """Six digits, without a negative zero."""
    return F.round(c, 6) + F.lit(0.0)
