"""Tables bucketed by their key, so that joining them and grouping by the key needs no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierflow.sinks import catalog


def save_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, location: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Write ``df`` as the catalog table ``name``, replacing it, in ``buckets`` buckets of its keys sorted by them.

    One shuffle deals the rows out as the buckets do, so each bucket is one file. Tables that are to be joined need equal
    keys and equal numbers of buckets; choose the number so that a bucket of the largest of them fits a task. ``df`` must
    not read the table it replaces.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("compression", "zstd")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_layers_bucketed(
    spark: SparkSession, database: str, location: str, tables: dict[str, DataFrame], key: str, buckets: int
) -> dict[str, DataFrame]:
    """Several layer tables of one database, bucketed alike by their common key; their stored frames by name."""
    catalog.ensure_database(spark, database, f"{location}/_catalog")
    return {
        name: save_bucketed(df, f"{database}.{name}", [key], buckets, f"{location}/{name}") for name, df in tables.items()
    }
