"""Databases, tables and views in the Spark catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import local_frame, path_exists
from tierflow.sinks.lake import Lake, Snapshot


def quoted(name: str) -> str:
    """Each part of a dotted name in back quotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table or view of that name, if there is one. Files of an external table stay."""
    if not spark.catalog.tableExists(name):
        return
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS {quoted(name)}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[tuple[str, str]],
    location: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    replace: bool = False,
) -> DataFrame:
    """Create a table from ``(name, type)`` pairs, if missing; ``replace`` drops an existing one first."""
    if replace:
        drop_table(spark, name)
    body = ", ".join(f"{quoted(column)} {dtype}" for column, dtype in columns)
    partitioned = f" PARTITIONED BY ({', '.join(quoted(c) for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({body}) USING {fmt}{partitioned}{place}")
    if partition_by and location and path_exists(spark, location):
        spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
    return spark.table(name)


def external_table(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> DataFrame:
    """A catalog table over files that are already there, replacing one of that name; the files stay when it is dropped.

    Columns come from the files, and the partitions on disk are entered into the catalog, so that later queries plan from
    the catalog instead of listing the whole folder.
    """
    fields = spark.read.format(fmt).load(path).schema.fields
    return create_table(spark, name, [(f.name, f.dataType.simpleString()) for f in fields], path, partition_by, fmt, replace=True)


def sync_partitions(spark: SparkSession, name: str) -> None:
    """Enter partitions that were added on disk into the catalog, and take out those that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(name)} SYNC PARTITIONS")


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Store row count, size and column statistics of a table (all columns by default) for the planner; one scan."""
    which = f"COLUMNS {', '.join(quoted(c) for c in columns)}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS FOR {which}")


def column_statistics(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """The stored statistics: per column ``least`` and ``greatest`` as text, ``nulls`` and an estimate of ``distinct``.

    Nothing of the table is read. Null where nothing was stored; texts have no least and greatest value.
    """
    lines = []
    for column in columns:
        facts = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {quoted(name)} {quoted(column)}").collect()}
        known = {key: value for key, value in facts.items() if value not in (None, "NULL")}
        counts = [int(known[key]) if key in known else None for key in ("num_nulls", "distinct_count")]
        lines.append((column, known.get("min"), known.get("max"), *counts))
    schema = T.StructType.fromDDL("`column` string, `least` string, `greatest` string, `nulls` bigint, `distinct` bigint")
    return local_frame(spark, lines, schema)


def create_view(lake: Lake, snapshot: Snapshot, complete: Sequence[str] = ()) -> str:
    """Point the table's view at a snapshot; returns the view's name.

    The column list is spelled out, so partition columns keep their place and type, and a directory without a column that
    was added later shows null. Directories in ``complete`` are known to hold every column and are not inspected.
    """
    name = f"{lake.database}.{snapshot.table}"
    spark = lake.spark
    fields = snapshot.schema.fields
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in fields)
    selects = []
    for path in snapshot.paths if snapshot.rows else ():
        stored = None if path in complete else spark.read.format(snapshot.format).load(path).columns
        columns = []
        for field in fields:
            target, column = field.dataType.simpleString(), quoted(field.name)
            if stored is not None and field.name not in stored:
                columns.append(f"CAST(NULL AS {target}) AS {column}")
            elif field.name in snapshot.partition_by:
                columns.append(f"CAST({column} AS {target}) AS {column}")
            else:
                columns.append(column)
        selects.append(f"SELECT {', '.join(columns)} FROM {snapshot.format}.`{path}`")
    body = " UNION ALL ".join(selects) if selects else f"SELECT {nothing} WHERE false"
    ensure_database(spark, lake.database, f"{lake.base}/_catalog")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {body}")
    return name


def register_layers(lake: Lake) -> list[str]:
    """Views for every published table of a lake, e.g. in a new session; returns their names."""
    return [create_view(lake, snapshot) for snapshot in lake.tables()]


def register_temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"USE {quoted(database)}")


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def describe(spark: SparkSession, name: str, extended: bool = False) -> DataFrame:
    """Columns of a table or view, with storage details if ``extended``."""
    return spark.sql(f"DESCRIBE {'EXTENDED ' if extended else ''}{quoted(name)}")


def describe_detail(lake: Lake, table: str) -> DataFrame:
    """One row: format, directories, partition columns, size and version of a published table."""
    found = lake.snapshot(table)
    if found is None:
        raise LookupError(f"{table!r} has not been published")
    return lake.log(table).filter(F.col("version") == found.version).drop("schema")


def describe_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columns of files that have no catalog entry."""
    return spark.sql(f"DESCRIBE QUERY SELECT * FROM {fmt}.`{path}`")
