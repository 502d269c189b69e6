"""A lake: published tables below one root, described by an append-only publish log.

Each publish writes a new directory and appends one row to the log; nothing is overwritten in place, so readers never see
half a write. A snapshot lists the directories that make up the table, which lets an append add one directory and keep
the others. One writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import local_frame, path_exists

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("paths", T.ArrayType(T.StringType())),
        T.StructField("partition_by", T.ArrayType(T.StringType())),
        T.StructField("format", T.StringType()),
        T.StructField("schema", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Snapshot:
    """One version of a table, as logged."""

    table: str
    version: int
    operation: str
    rows: int
    files: int
    bytes: int
    paths: tuple[str, ...]
    partition_by: tuple[str, ...]
    format: str
    schema: T.StructType
    ts: dt.datetime | None = None

    def log_row(self) -> tuple:
        return (
            self.table, self.version, self.ts, self.operation, self.rows, self.files, self.bytes, list(self.paths),
            list(self.partition_by), self.format, self.schema.json(),
        )


def _snapshot(row) -> Snapshot:
    return Snapshot(
        row["table"], row["version"], row["operation"], row["rows"], row["files"], row["bytes"], tuple(row["paths"]),
        tuple(row["partition_by"]), row["format"], T.StructType.fromJson(json.loads(row["schema"])), row["ts"],
    )


@dataclass(frozen=True)
class Lake:
    """Root folder (any Hadoop path), catalog database for the views, and file format."""

    spark: SparkSession
    root: str
    database: str = "lake"
    format: str = "parquet"

    @property
    def base(self) -> str:
        return self.root.rstrip("/")

    @property
    def log_path(self) -> str:
        return f"{self.base}/_publish_log"

    def table_root(self, table: str) -> str:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", table):
            raise ValueError(f"{table!r} is not a plain table name")
        return f"{self.base}/{table}"

    def log(self, table: str | None = None) -> DataFrame:
        """The publish log, of one table or of all; empty for a new lake.

        Every table logs to its own folder, so tables can be published side by side.
        """
        folder = self.log_path if table is None else f"{self.log_path}/table={table}"
        if not path_exists(self.spark, folder):
            return local_frame(self.spark, [], LOG_SCHEMA)
        reader = self.spark.read.schema(LOG_SCHEMA).option("basePath", self.log_path)
        return reader.parquet(folder).select(*LOG_SCHEMA.fieldNames())

    def append_log(self, snapshot: Snapshot) -> Snapshot:
        stamped = replace(snapshot, ts=snapshot.ts or dt.datetime.now(dt.timezone.utc))
        line = local_frame(self.spark, [stamped.log_row()], LOG_SCHEMA).drop("table").coalesce(1)
        line.write.mode("append").parquet(f"{self.log_path}/table={stamped.table}")
        return stamped

    def snapshot(
        self, table: str, version: int | None = None, as_of: dt.datetime | None = None
    ) -> Snapshot | None:
        """The latest snapshot, the one of a version, or the latest at a point in time; ``None`` if there is none."""
        rows = self.log(table)
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        if as_of is not None:
            rows = rows.filter(F.col("ts") <= F.lit(as_of))
        latest = rows.orderBy(F.col("version").desc()).first()
        return None if latest is None else _snapshot(latest)

    def tables(self) -> list[Snapshot]:
        """The latest snapshot of every table; one row per published table."""
        latest = self.log().groupBy("table").agg(F.max_by(F.struct(*LOG_SCHEMA.fieldNames()), "version").alias("s"))
        return [_snapshot(row["s"]) for row in latest.orderBy("table").collect()]


def read_paths(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Union of the directories of a snapshot; columns that an older directory lacks are null."""
    if not paths:
        return local_frame(spark, [], schema)
    frames = [spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames()) for path in paths]
    return reduce(lambda left, right: left.unionByName(right), frames)


def read_snapshot(
    lake: Lake, table: str, version: int | None = None, as_of: dt.datetime | None = None
) -> DataFrame:
    """The table as published; an older ``version``, or the state ``as_of`` a time, for time travel."""
    found = lake.snapshot(table, version, as_of)
    if found is None:
        raise LookupError(f"no snapshot of {table!r} for version={version} as_of={as_of}")
    missing = [path for path in found.paths if not path_exists(lake.spark, path)]
    if missing:
        raise LookupError(f"snapshot {found.version} of {table!r} has expired; removed: {missing}")
    return read_paths(lake.spark, found.paths, found.schema, found.format)


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> tuple[int, int]:
    """Number and total bytes of the data files below the directories; lists files without reading them."""
    if not paths:
        return 0, 0
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(list(paths))
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .first()
    )
    return files["files"], files["bytes"]
