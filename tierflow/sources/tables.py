"""Parquet, other columnar and catalog tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    ignore_missing: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan of stored files; ``fmt`` is any source on the class path, such as ``delta``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path if isinstance(path, str) else list(path))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan of a catalog table or view by name."""
    return spark.table(name)


def read_date_range(
    spark: SparkSession,
    path: str,
    first: dt.date | str,
    last: dt.date | str,
    date: str = "Date",
    fmt: str = "parquet",
) -> DataFrame:
    """Rows of ``first..last``. On a table partitioned by the date only those partitions are listed and read."""
    return in_date_range(read_table(spark, path, fmt), first, last, date)


def in_date_range(df: DataFrame, first: dt.date | str, last: dt.date | str, date: str = "Date") -> DataFrame:
    low, high = (value if isinstance(value, dt.date) else dt.date.fromisoformat(value) for value in (first, last))
    return df.filter(F.col(date).between(F.lit(low), F.lit(high)))


def on_days(df: DataFrame, calendar: DataFrame, day: str = "day", date: str = "Date") -> DataFrame:
    """Rows of the days that a (filtered) calendar table names; rows without a date and repeated days add nothing.

    On a table partitioned by the date, the calendar's days prune its partitions when the query runs: Spark reads the
    calendar first if it broadcasts it for the join, which is its own choice by size.
    """
    return df.join(calendar.select(F.col(day).alias(date)), date, "left_semi").select(*df.columns)


def partition_paths(
    spark: SparkSession, root: str, first: dt.date | str, last: dt.date | str, date: str = "Date", fmt: str = "parquet"
) -> DataFrame:
    """The same rows from named leaf partitions only; the base path keeps the partition column.

    For stores where listing the whole root is expensive. Every day of the range must exist unless missing files are
    ignored by the session.
    """
    low, high = (value if isinstance(value, dt.date) else dt.date.fromisoformat(value) for value in (first, last))
    paths = [f"{root}/{date}={low + dt.timedelta(days=i)}" for i in range((high - low).days + 1)]
    return spark.read.format(fmt).option("basePath", root).load(paths)
