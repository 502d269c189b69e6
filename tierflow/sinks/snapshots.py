"""Publishing tables: write, audit, then make visible."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.ordering import curve_bits, with_z_value
from tierflow.operators import quality
from tierflow.runtime import delete_path, path_exists, session_conf, stage
from tierflow.sinks import catalog
from tierflow.sinks.lake import Lake, Snapshot, file_sizes, read_paths, read_snapshot

TARGET_FILE_BYTES = 256 * 1024 * 1024
# What one task sorts at most when it clusters, about: rows, and bytes of their stored form. A file of more is put together
# from sorted pieces.
SORT_ROWS, SORT_BYTES = 2_000_000, 64 * 1024 * 1024
FILES_PER_JOB = 128  # files that one job puts together: bounds its plan, which has a scan per piece
OPEN_WRITERS = 64  # directories that a task writes side by side before it sorts the rest of its rows by directory
# Writes of tables whose directories lie whole in one shuffle partition, or in one cut out of it. Merging shuffle partitions
# would save no file, and a task has few directories: written side by side, their rows need no sort that holds them all.
BY_DIRECTORY = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_WRITERS),
}
QUARANTINE_SUFFIX = "_quarantine"
KEPT = "__kept"  # directory level that tells valid rows from the others while a quarantined table is written
# Types whose text in a partition directory reads back as the same type.
PARTITION_TYPES = (T.DateType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Layout:
    """How the rows of a snapshot are spread over files.

    ``compact`` merges small partitions and splits large ones to about ``target_bytes``. ``cluster_by`` sorts the table by
    one column, or along a z-order curve of several, so that file statistics exclude most files for a filter on them.
    """

    compact: bool = False
    cluster_by: tuple[str, ...] = ()
    target_bytes: int = TARGET_FILE_BYTES
    max_records: int = 0
    bits: int = 0


def clustered(
    df: DataFrame, columns: Sequence[str], partitions: int, rows: int, partition_by: Sequence[str] = (), bits: int = 0
) -> DataFrame:
    """``df`` range-partitioned and sorted along the columns. ``df`` must be a scan of stored files.

    Cells of the z-order curve are cut further by the columns themselves, and equal values by the row's position in the
    scan, so a value held by a large share of the rows gets as many partitions as its size needs. ``bits`` per column of the
    curve default to what the number of partitions needs.
    """
    names = list(columns)
    keyed, order = df, [*partition_by, *names]
    if len(names) > 1:
        bits = bits or curve_bits(len(names), partitions)
        keyed, order = with_z_value(df, names, bits, rows, "__curve"), [*partition_by, "__curve", *names]
    if partitions == 1:
        placed = keyed.repartition(1)
    else:
        placed = keyed.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(partitions, *order, "__row")
    return placed.sortWithinPartitions(*order).select(*df.columns)


def _sorted_pieces(spark: SparkSession, path: str, pieces: int) -> list[list[str]]:
    """The files of a range-partitioned stage, in order, ``pieces`` neighbouring partitions to a group."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    # a row per piece; the files are named part-<partition>-...
    numbered = sorted((int(row["path"].rsplit("/", 1)[1].split("-")[1]), row["path"]) for row in listed)
    groups: dict[int, list[str]] = {}
    for number, name in numbered:
        groups.setdefault(number // pieces, []).append(name)
    return [groups[number] for number in sorted(groups)]


def _concatenated(spark: SparkSession, groups: Sequence[Sequence[str]], schema: T.StructType) -> DataFrame:
    """Stored pieces with one partition per group that reads its pieces one after the other."""

    def union(frames: list[DataFrame]) -> DataFrame:
        while len(frames) > 1:  # as a balanced tree: a chain of many would be slow to analyse
            frames = [reduce(DataFrame.union, frames[i : i + 2]) for i in range(0, len(frames), 2)]
        return frames[0]

    return union([union([spark.read.schema(schema).parquet(name) for name in group]).coalesce(1) for group in groups])


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    layout: Layout | None = None,
    rows: int | None = None,
    size: int | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    spread: bool = True,
) -> None:
    """Write ``df`` as zstd files; partitioned tables get about one file per partition and ``target_bytes``, unsorted.

    ``rows`` and ``size`` of a stored input let clustering skip measuring it; without them the input is staged first.
    If a clustered file holds more than a task should sort, its range is cut into pieces, which are sorted and stored by
    tasks of their own and then read in order into the file. ``watch`` is put on the rows as the first tasks that write see
    them, after any exchange, so that a repeated stage counts no row twice. Without ``spread`` partitioned tables are written
    from the partitions that ``df`` has, as other tables are.
    """
    layout = layout or Layout()
    spark = df.sparkSession
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(layout.target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    staged, pieced = None, None
    if layout.cluster_by:
        if rows is None or size is None:
            df, staged = stage(df, "measured")
            rows, size = df.count(), file_sizes(spark, [staged])[1]
        partitions = max(1, math.ceil(size / layout.target_bytes))
        pieces = max(1, math.ceil(rows / partitions / SORT_ROWS), math.ceil(size / partitions / SORT_BYTES))
        out = clustered(df, layout.cluster_by, partitions * pieces, rows, partition_by, layout.bits)
        settings = {}
        if pieces > 1:
            pieced = stage(watch(out) if watch else out, "pieces")[1]
            # Unions of single partitions must not be zipped into one, and a piece is read whole.
            settings = {
                "spark.sql.unionOutputPartitioning": "false",
                "spark.sql.files.minPartitionNum": "1",
                "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_WRITERS),
            }
    elif layout.compact or (partition_by and spread):
        out = df.hint("rebalance", *partition_by)
        if partition_by:
            settings |= BY_DIRECTORY
    else:
        out, settings = df, {}

    def save(out: DataFrame, mode: str) -> None:
        writer = out.write.format(fmt).option("compression", "zstd").mode(mode)
        if layout.max_records:
            writer = writer.option("maxRecordsPerFile", layout.max_records)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with session_conf(spark, settings):
            writer.save(path)

    if pieced is None:
        save(watch(out) if watch else out, "overwrite")
    else:
        groups = _sorted_pieces(spark, pieced, pieces)
        for start in range(0, len(groups), FILES_PER_JOB):
            some = _concatenated(spark, groups[start : start + FILES_PER_JOB], out.schema)
            save(some, "append" if start else "overwrite")
    for scratch in (staged, pieced):
        if scratch is not None:
            delete_path(spark, scratch)


def _check_partition_types(schema: T.StructType, partition_by: Sequence[str]) -> None:
    for name in partition_by:
        if not isinstance(schema[name].dataType, PARTITION_TYPES):
            raise ValueError(f"cannot partition by {name}: use a date or integer column")


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; columns it lacks are null."""
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in schema.fields}


def publish(
    lake: Lake,
    df: DataFrame,
    table: str,
    *,
    append: bool = False,
    evolve: bool = False,
    partition_by: Sequence[str] | None = None,
    rules: quality.TableRules | None = None,
    policy: str = "fail",
    layout: Layout | None = None,
    operation: str | None = None,
    stored: tuple[int, int] | None = None,
    ts: dt.datetime | None = None,
) -> Snapshot:
    """Write ``df`` as the next snapshot of a table, audit what was written, then make it the current one.

    The rules are counted by the job that writes the files, which are not read again for it. Under the ``fail`` policy a broken rule raises and the table
    stays as it was; under ``quarantine`` the bad rows go to ``<table>_quarantine``, which holds those of the
    rows now published: an append adds to it, an overwrite replaces it, be it by nothing. ``append`` adds the rows to those
    already published. A change of columns needs ``evolve``; when appending, columns missing on either side are null.
    ``stored`` gives rows and bytes of ``df`` if it is a scan of files that were already measured.
    """
    spark = lake.spark
    current = lake.snapshot(table)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    if partition_by is None:
        partition_by = current.partition_by if current else ()
    partition_by = tuple(partition_by)
    _check_partition_types(schema, partition_by)
    if current is not None and _types(current.schema) != _types(schema):
        if not evolve:
            raise ValueError(f"{table} has other columns; publish with evolve=True to change them")
        if append:
            known = _types(current.schema)
            changed = [f.name for f in schema.fields if f.name in known and known[f.name] != f.dataType]
            if changed:
                raise ValueError(f"appending cannot change the type of {changed}")
            schema = T.StructType(current.schema.fields + [f for f in schema.fields if f.name not in known])

    version = (current.version if current else 0) + 1
    path = f"{lake.table_root(table)}/snapshot={version:08d}"
    # Clustering reads its input more than once, so rows that are not yet stored are staged first.
    staging = layout is not None and bool(layout.cluster_by) and stored is None
    first = f"{path}-stage" if staging else path
    audits: list[Callable[[], quality.Audit | None]] = []

    def watch(out: DataFrame) -> DataFrame:
        observed, result = quality.audited(out, rules)
        audits.append(result)
        return observed

    watched = watch if rules is not None else None
    aligned = _aligned(df, schema)
    # Without clustering the writing job itself puts valid and other rows in different directories.
    parted = rules is not None and policy == "quarantine" and not (layout and layout.cluster_by)
    if parted and KEPT in df.columns:
        raise ValueError(f"{KEPT} is a reserved name under the quarantine policy")
    if staging:
        write_files(aligned, first, lake.format, watch=watched)
    elif parted:
        split = aligned.withColumn(KEPT, quality.is_valid(aligned, rules))
        with session_conf(spark, {} if partition_by else {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
            write_files(split, first, lake.format, (KEPT, *partition_by), layout, watch=watched, spread=bool(partition_by))
    else:
        rows, size = stored or (None, None)
        write_files(aligned, first, lake.format, partition_by, layout, rows, size, watched)

    if parted:
        path = f"{first}/{KEPT}=true"
        if not path_exists(spark, path):  # no valid row
            write_files(aligned.filter(F.lit(False)), path, lake.format)
    written = read_paths(spark, [path if parted else first], schema, lake.format)
    valid, invalid, added = written, None, None
    if parted:
        bad_path = f"{first}/{KEPT}=false"
        try:
            bad = read_paths(spark, [bad_path] if path_exists(spark, bad_path) else [], schema, lake.format)
            invalid = quality.enforce(bad, rules, policy, audits[-1]())[1]
        except quality.QualityError:
            delete_path(spark, first)
            raise
    elif rules is not None:
        try:
            valid, invalid, audit = quality.enforce(written, rules, policy, audits[-1]())
        except quality.QualityError:
            delete_path(spark, first)
            raise
        added = audit.rows
    quarantine = table + QUARANTINE_SUFFIX
    if invalid is not None:
        publish(lake, invalid, quarantine, append=append, evolve=True, partition_by=(), ts=ts)
    elif rules is not None and policy == "quarantine" and not append and lake.snapshot(quarantine) is not None:
        publish(lake, read_snapshot(lake, quarantine).filter(F.lit(False)), quarantine, evolve=True, partition_by=(), ts=ts)
    if parted and invalid is not None:
        delete_path(spark, bad_path)
    elif staging or invalid is not None:
        if not staging:
            path = f"{path}-valid"
        rows, size = added if added is not None else written.count(), file_sizes(spark, [first])[1]
        write_files(valid, path, lake.format, partition_by, layout, rows, size)
        delete_path(spark, first)
        written = read_paths(spark, [path], schema, lake.format)

    if added is None or invalid is not None:
        added = written.count()
    files, size = file_sizes(spark, [path])
    paths: tuple[str, ...] = (path,)
    if append and current is not None and current.rows:
        if added:
            paths = (*current.paths, path)
        else:
            paths, files, size = current.paths, 0, 0
            delete_path(spark, path)
        added, files, size = added + current.rows, files + current.files, size + current.bytes
    snapshot = Snapshot(
        table, version, operation or ("append" if append else "overwrite"), added, files, size, paths, partition_by,
        lake.format, schema, ts,
    )
    snapshot = lake.append_log(snapshot)
    catalog.create_view(lake, snapshot, complete=[path])
    return snapshot


def delete_where(lake: Lake, table: str, predicate: Column | str | None = None, ts: dt.datetime | None = None) -> Snapshot:
    """Publish the table without the rows that match; without a predicate, without any row."""
    df = read_snapshot(lake, table)
    if predicate is None:
        kept = df.filter(F.lit(False))
    else:
        matches = F.expr(predicate) if isinstance(predicate, str) else predicate
        kept = df.filter(~F.coalesce(matches, F.lit(False)))
    return publish(lake, kept, table, operation="delete", ts=ts)


def history(lake: Lake, table: str | None = None) -> DataFrame:
    """The publish log, newest first, of one table or of all."""
    return lake.log(table).orderBy(F.col("table").asc(), F.col("version").desc())


def load_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """Insert a frame into a catalog table, columns matched by name.

    ``append`` adds the rows, ``overwrite`` replaces the table, ``overwrite_partitions`` replaces only the partitions the
    frame holds.
    """
    spark = df.sparkSession
    ordered = df.select(*spark.table(name).columns)
    if mode == "append":
        ordered.write.insertInto(name)
    elif mode in ("overwrite", "overwrite_partitions"):
        scope = "dynamic" if mode == "overwrite_partitions" else "static"
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": scope}):
            ordered.write.insertInto(name, overwrite=True)
    else:
        raise ValueError(f"unknown mode {mode!r}")
