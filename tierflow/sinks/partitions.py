"""Maintenance of a directory table by partition: only partitions with something to do are rewritten.

The table is a plain directory of files, partitioned by date or integer columns, with one writer. A rewrite goes through a
dynamic partition overwrite: new files are written aside and moved in when the job commits, partition by partition. A
failed job leaves each partition with its old rows or its new ones, and running the same call again completes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import delete_path, local_frame, session_conf
from tierflow.sinks.snapshots import BY_DIRECTORY, TARGET_FILE_BYTES

FILES = "part-*"
RUN_FILES = 1000
REPORT_SCHEMA = "partitions bigint, rewritten bigint, files_before bigint, files_after bigint"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a table with their partition values, ``file`` (as in ``_metadata.file_path``), ``folder`` and
    ``bytes``; files are listed, not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FILES).load(path)
    inner = ("modificationTime", "content", "path", "length")
    return listed.select(
        *[c for c in listed.columns if c not in inner],
        F.col("_metadata.file_path").alias("file"),
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.col("length").alias("bytes"),
    )


def _in(partition_by: Sequence[str], values: Sequence[Sequence[Any]]) -> Column:
    """Whether a row lies in one of the partitions; null is a value of its own. Evaluated on directories, not on rows."""
    if len(partition_by) == 1:
        name = F.col(partition_by[0])
        known = [v[0] for v in values if v[0] is not None]
        found = F.coalesce(name.isin(known), F.lit(False)) if known else F.lit(False)
        return found | name.isNull() if len(known) < len(values) else found
    each = [
        reduce(lambda a, b: a & b, (F.col(name).eqNullSafe(F.lit(v)) for name, v in zip(partition_by, row))) for row in values
    ]
    while len(each) > 1:  # as a balanced tree: a chain of thousands would be too deep to analyse
        each = [reduce(lambda a, b: a | b, each[i : i + 2]) for i in range(0, len(each), 2)]
    return each[0]


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> None:
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with session_conf(df.sparkSession, BY_DIRECTORY):
        writer.option("compression", "zstd").partitionBy(*partition_by).save(path)


def pack_files(
    files: DataFrame, partition_by: Sequence[str], target_bytes: int = TARGET_FILE_BYTES, run: int = RUN_FILES
) -> DataFrame:
    """``data_files`` with a ``bin`` per file, from 0 in each partition, and the partition's number of ``bins``.

    Next fit by falling size: a bin holds at most ``target_bytes``, or one larger file, and two neighbouring bins are
    together above the target, so there are at most twice as many as needed. The files of a partition are packed in runs of
    ``run`` files, each with a last bin of its own, so that the work grows with the number of files.
    """
    keys = list(partition_by)
    order = Window.partitionBy(*keys).orderBy(F.desc("bytes"), F.desc("file"))
    runs = files.withColumn("__run", F.floor((F.row_number().over(order) - 1) / run))
    listed = runs.groupBy(*keys, "__run").agg(
        F.sort_array(F.collect_list(F.struct("bytes", "file")), asc=False).alias("__files")
    )
    start = F.struct(F.lit(-1).alias("bin"), F.lit(target_bytes).cast("bigint").alias("fill"), F.array().cast("array<int>").alias("bins"))

    def place(state: Column, item: Column) -> Column:
        fits = (state["fill"] + item["bytes"] <= F.lit(target_bytes)) & (state["bin"] >= 0)
        number = F.when(fits, state["bin"]).otherwise(state["bin"] + 1)
        fill = F.when(fits, state["fill"] + item["bytes"]).otherwise(item["bytes"])
        return F.struct(number.alias("bin"), fill.alias("fill"), F.concat(state["bins"], F.array(number)).alias("bins"))

    packed = listed.withColumn("__bins", F.aggregate("__files", start, place, lambda state: state["bins"]))
    counted = packed.withColumn("__count", F.array_max("__bins") + 1)
    upto = F.sum("__count").over(Window.partitionBy(*keys).orderBy("__run"))
    total = F.sum("__count").over(Window.partitionBy(*keys))
    numbered = counted.withColumns({"__before": (upto - F.col("__count")).cast("int"), "bins": total.cast("int")})
    paired = F.arrays_zip(F.col("__files").alias("f"), F.col("__bins").alias("b"))
    numbered = numbered.select(*keys, "__before", "bins", F.explode(paired).alias("__one"))
    one = F.col("__one")
    return numbered.select(
        *keys, one["f"]["file"].alias("file"), one["f"]["bytes"].alias("bytes"), (F.col("__before") + one["b"]).alias("bin"), "bins"
    )


def compact_partitions(
    spark: SparkSession, path: str, partition_by: Sequence[str], target_bytes: int = TARGET_FILE_BYTES, fmt: str = "parquet"
) -> DataFrame:
    """Merge the small files of the partitions that have too many; one row: partitions, how many were rewritten, files.

    A partition is fragmented if its files fit into at most half as many bins of ``target_bytes``; the others keep their
    files. The files of a bin go to one task and become one file, sized by what they held on disk. The plan has a row per
    file of the fragmented partitions; it joins the rows by file name, without a shuffle if it is small enough to broadcast.
    """
    keys = list(partition_by)
    files = data_files(spark, path)
    plan = pack_files(files, keys, target_bytes)
    counted = plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.max("bins").alias("bins")).collect()
    fragmented = [row for row in counted if row["files"] >= 2 * row["bins"]]
    after = sum(row["bins"] if row["files"] >= 2 * row["bins"] else row["files"] for row in counted)
    if fragmented:
        first, ids = 0, []
        for row in fragmented:
            ids.append((*[row[k] for k in keys], first))
            first += row["bins"]
        schema = T.StructType([*[files.schema[k] for k in keys], T.StructField("__first", T.IntegerType())])
        starts = local_frame(spark, ids, schema).toDF(*[f"__{k}" for k in keys], "__first")
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
        numbered = plan.join(starts, same).select(F.col("file").alias("__file"), (F.col("__first") + F.col("bin")).alias("__bin"))
        touched = [tuple(row[k] for k in keys) for row in fragmented]
        rows = spark.read.format(fmt).load(path).filter(_in(keys, touched))
        columns = rows.columns
        placed = rows.withColumn("__file", F.col("_metadata.file_path")).join(numbered, "__file", "left")
        _overwrite(placed.repartitionById(first, "__bin").select(*columns), path, keys, fmt)
    line = (len(counted), len(fragmented), sum(row["files"] for row in counted), after)
    return local_frame(spark, [line], T.StructType.fromDDL(REPORT_SCHEMA))


def delete_in_partitions(
    spark: SparkSession, path: str, predicate: Column | str, partition_by: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """Delete the rows that match; one row per partition that held one: partition values, ``deleted``, ``kept``.

    One scan of the predicate's columns finds the partitions; only those are rewritten, and one that loses every row is
    removed. A row for which the predicate is null stays. A filter on partition columns alone reads no file twice: whole
    partitions go without a rewrite.
    """
    keys = list(partition_by)
    matches = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    table = spark.read.format(fmt).load(path)
    counts = table.groupBy(*keys).agg(F.count_if(matches).alias("deleted"), F.count_if(~matches).alias("kept"))
    found = counts.filter(F.col("deleted") > 0)
    touched = found.collect()  # at most one row per directory
    changed = [tuple(row[k] for k in keys) for row in touched if row["kept"]]
    if changed:
        kept = table.filter(_in(keys, changed)).filter(~matches)
        _overwrite(kept.hint("rebalance", *keys), path, keys, fmt)
    emptied = [tuple(row[k] for k in keys) for row in touched if not row["kept"]]
    if emptied:
        gone = data_files(spark, path).filter(_in(keys, emptied))
        for row in gone.select("folder").distinct().collect():
            delete_path(spark, row["folder"])
    return local_frame(spark, [tuple(row) for row in touched], found.schema)
