"""Memory of the tasks that write partitioned tables: none of it grows with the rows of a directory."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tierflow import workload
from tierflow.runtime import scratch_path
from tierflow.sinks import Lake, Layout, publish
from tierflow.sinks.partitions import compact_partitions, delete_in_partitions
from tierflow.sinks.snapshots import OPEN_WRITERS, write_files


def writing_tasks(spark, folder, action):
    """Rows written and peak execution memory of every task of ``action`` that wrote rows, from an event log of its own."""
    context, jvm = spark.sparkContext._jsc.sc(), spark._jvm
    conf = context.conf().clone().set("spark.eventLog.compress", "false").set("spark.eventLog.rolling.enabled", "false")
    uri = jvm.java.io.File(str(folder)).toURI()
    log = jvm.org.apache.spark.scheduler.EventLoggingListener("writes", jvm.scala.Option.empty(), uri, conf, context.hadoopConfiguration())
    log.start()
    context.addSparkListener(log)
    try:
        action()
        context.listenerBus().waitUntilEmpty()
    finally:
        context.removeSparkListener(log)
        log.stop()
    (name,) = [n for n in os.listdir(folder) if not n.startswith(".")]
    with open(os.path.join(folder, name)) as lines:
        ends = [e for e in map(json.loads, lines) if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics")]
    each = [(e["Task Metrics"]["Output Metrics"]["Records Written"], e["Task Metrics"]["Peak Execution Memory"]) for e in ends]
    return [(rows, peak) for rows, peak in each if rows]


def by_day(spark, days, rows=40_000):
    """One day has nine tenths of the rows; some days are null."""
    number = F.when(F.col("id") % 10 > 0, F.lit(0)).when(F.col("id") % 100 > 0, (F.col("id") / 10).cast("int") % days)
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), number)
    return spark.range(0, rows, 1, 4).select("id", day.alias("Date"), F.concat(F.lit("n"), F.col("id")).alias("name"))


def same(left, right):
    assert left.count() == right.count() and left.exceptAll(right).count() == 0


@pytest.mark.parametrize("layout", [None, Layout(compact=True)])
def test_a_partitioned_write_does_not_sort_its_rows(spark, tmp_path, layout):
    path, df = scratch_path(spark, "days"), by_day(spark, 30)
    tasks = writing_tasks(spark, tmp_path, lambda: write_files(df, path, partition_by=["Date"], layout=layout))
    assert sum(rows for rows, _ in tasks) == 40_000 and {peak for _, peak in tasks} == {0}
    stored = spark.read.parquet(path).select(*df.columns)
    same(stored, df)
    assert stored.select("Date", "_metadata.file_path").distinct().count() == df.select("Date").distinct().count()


def test_publishing_by_day_does_not_sort(spark, tmp_path):
    lake, df = Lake(spark, scratch_path(spark, "lake"), "write_memory"), by_day(spark, 30)
    tasks = writing_tasks(spark, tmp_path, lambda: publish(lake, df, "t", partition_by=["Date"]))
    assert {peak for _, peak in tasks} == {0}
    same(spark.table("write_memory.t"), df)


def test_more_directories_than_a_task_holds_open(spark):
    """The rest of the task's rows is sorted; every directory still gets one file."""
    path, df = scratch_path(spark, "days"), by_day(spark, 6 * OPEN_WRITERS)
    write_files(df, path, partition_by=["Date"])
    stored = spark.read.parquet(path).select(*df.columns)
    same(stored, df)
    assert stored.select("Date", "_metadata.file_path").distinct().count() == df.select("Date").distinct().count() > 4 * OPEN_WRITERS


def test_deleting_by_day_does_not_sort_what_it_keeps(spark, tmp_path):
    path, df = scratch_path(spark, "days"), by_day(spark, 30)
    write_files(df, path, partition_by=["Date"])
    gone = "id % 7 = 0 OR Date = DATE'2024-01-03'"
    tasks = writing_tasks(spark, tmp_path, lambda: delete_in_partitions(spark, path, gone, ["Date"]))
    assert {peak for _, peak in tasks} == {0}
    left = df.filter(f"NOT coalesce({gone}, false)")
    assert sum(rows for rows, _ in tasks) == left.count()
    stored = spark.read.parquet(path).select(*df.columns)
    same(stored, left)
    assert stored.select("Date", "_metadata.file_path").distinct().count() == left.select("Date").distinct().count()


def test_compacting_by_day_does_not_sort(spark, tmp_path):
    path, df = scratch_path(spark, "days"), by_day(spark, 5)
    df.repartition(8).write.partitionBy("Date").parquet(path)
    tasks = writing_tasks(spark, tmp_path, lambda: compact_partitions(spark, path, ["Date"]))
    assert sum(rows for rows, _ in tasks) == 40_000 and {peak for _, peak in tasks} == {0}
    stored = spark.read.parquet(path).select(*df.columns)
    same(stored, df)
    assert stored.select("Date", "_metadata.file_path").distinct().count() == df.select("Date").distinct().count()


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with an events table of twelve days and a null day."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = by_day(spark, 12, 4_000).select(
        F.col("id").alias("event_id"), F.col("Date").cast("timestamp_ntz").alias("ts"), (F.col("id") % 9).alias("user_id"),
        F.when(F.col("id") % 3 > 0, "error").otherwise("view").alias("event_type"), (F.col("id") % 7 + 0.5).alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["date_range_scan", "calendar_days_scan", "missing_files_ignored", "publish_read_back"])
def test_queries_write_the_days_without_a_sort(spark, events, tmp_path, name):
    tasks = writing_tasks(spark, tmp_path, lambda: workload.QUERIES[name](spark, events))
    large = [(rows, peak) for rows, peak in tasks if rows > 20]  # not the log row of a lake or the days of a calendar
    assert sum(rows for rows, _ in large) == 4_000 and {peak for _, peak in large} == {0}
