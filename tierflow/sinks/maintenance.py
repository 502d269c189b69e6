"""Compaction, clustering and expiry of published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import delete_path, local_frame
from tierflow.sinks.lake import Lake, Snapshot, read_snapshot
from tierflow.sinks.snapshots import TARGET_FILE_BYTES, Layout, publish

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("files_before", T.LongType()),
        T.StructField("files_after", T.LongType()),
        T.StructField("bytes_before", T.LongType()),
        T.StructField("bytes_after", T.LongType()),
    ]
)


def _rewrite(lake: Lake, table: str, layout: Layout, operation: str) -> DataFrame:
    before = lake.snapshot(table)
    if before is None:
        raise LookupError(f"{table!r} has not been published")
    after: Snapshot = publish(
        lake, read_snapshot(lake, table), table, layout=layout, operation=operation, stored=(before.rows, before.bytes)
    )
    if after.rows != before.rows:
        raise RuntimeError(f"{operation} of {table!r} changed the row count from {before.rows} to {after.rows}")
    line = (table, operation, after.version, after.rows, before.files, after.files, before.bytes, after.bytes)
    return local_frame(lake.spark, [line], METRICS_SCHEMA)


def compact(lake: Lake, table: str, target_bytes: int = TARGET_FILE_BYTES, max_records: int = 0) -> DataFrame:
    """Rewrite a table into files of about ``target_bytes``; one row of metrics, before and after."""
    return _rewrite(lake, table, Layout(compact=True, target_bytes=target_bytes, max_records=max_records), "compact")


def zorder(
    lake: Lake, table: str, columns: Sequence[str] | str, target_bytes: int = TARGET_FILE_BYTES, bits: int = 0
) -> DataFrame:
    """Rewrite a table clustered by the columns; one row of metrics, before and after."""
    names = (columns,) if isinstance(columns, str) else tuple(columns)
    return _rewrite(lake, table, Layout(cluster_by=names, target_bytes=target_bytes, bits=bits), "zorder")


def zone_map(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a scan: its rows and the least and greatest value of each column, as a filter on them sees the file."""
    ends = [end(name).alias(f"{label}_{name}") for name in columns for label, end in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def opened_share(zones: DataFrame, columns: Sequence[str], parts: int = 16) -> DataFrame:
    """How much of a table a filter must open: per numeric column ``files``, ``rows`` and ``opened``.

    The span of the column's values is cut into ``parts`` equal ranges; ``opened`` is the mean share of files whose values
    may lie in one of them. Near 1 the layout does not help; a file without any value is never opened. ``zones`` is read
    twice, so pass a stored one.
    """
    counted = []
    for name in columns:
        least, greatest = F.col(f"min_{name}"), F.col(f"max_{name}")
        low = zones.agg(F.min(least)).scalar()
        high = zones.agg(F.max(greatest)).scalar()

        def part(value: Column, low: Column = low, high: Column = high) -> Column:
            place = F.when(high > low, (value - low).cast("double") * parts / (high - low)).otherwise(F.lit(0))
            return F.least(F.floor(place), F.lit(parts - 1))

        spans = F.when(least.isNull(), F.lit(0)).otherwise(part(greatest) - part(least) + 1)
        counted.append(F.struct(F.lit(name).alias("column"), F.sum(spans).alias("opened")))
    total = zones.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.array(*counted).alias("found"))
    share = F.col("one.opened") / (F.col("files") * parts)
    return total.select("files", "rows", F.explode("found").alias("one")).select("one.column", "files", "rows", share.alias("opened"))


def metrics_json(metrics: DataFrame) -> DataFrame:
    """The metrics as one JSON text per row."""
    return metrics.select(F.to_json(F.struct("*")).alias("metrics"))


def snapshot_ages(log: DataFrame, now: Column | dt.datetime | None = None) -> DataFrame:
    """The log with each snapshot's age in days and whether it is its table's current one."""
    at = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
    newest = F.row_number().over(Window.partitionBy("table").orderBy(F.col("version").desc()))
    age = (F.unix_micros(at.cast("timestamp")) - F.unix_micros("ts")) / F.lit(86_400_000_000)
    return log.withColumn("current", newest == 1).withColumn("age_days", age)


def expired_snapshots(
    lake: Lake, retention_days: float = 7, table: str | None = None, now: Column | dt.datetime | None = None
) -> DataFrame:
    """Snapshots older than the retention that are not their table's current one."""
    log = lake.log(table)
    return snapshot_ages(log, now).filter(~F.col("current") & (F.col("age_days") > retention_days))


def expired_paths(
    lake: Lake, retention_days: float = 7, table: str | None = None, now: Column | dt.datetime | None = None
) -> DataFrame:
    """Directories that only expired snapshots use; a directory an unexpired snapshot still lists is kept."""
    expired = expired_snapshots(lake, retention_days, table, now).select("table", "version", "paths")
    unexpired = lake.log(table).join(expired.select("table", "version"), ["table", "version"], "left_anti")
    in_use = unexpired.select("table", F.explode("paths").alias("path"))
    return expired.select("table", F.explode("paths").alias("path")).distinct().join(in_use, ["table", "path"], "left_anti")


def vacuum(
    lake: Lake,
    table: str,
    retention_days: float = 7,
    now: Column | dt.datetime | None = None,
    dry_run: bool = False,
) -> list[str]:
    """Remove the directories of expired snapshots of a table; returns them.

    The list is bounded by the number of publishes, not by the data.
    """
    paths = [row["path"] for row in expired_paths(lake, retention_days, table, now).orderBy("path").collect()]
    if not dry_run:
        for path in paths:
            delete_path(lake.spark, path)
    return paths
