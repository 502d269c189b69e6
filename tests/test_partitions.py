"""Compaction and deletion by partition: results, and files that must not change."""

import os

import pytest
from pyspark.sql import functions as F

from tierflow.runtime import scratch_path
from tierflow.sinks.partitions import compact_partitions, data_files, delete_in_partitions, pack_files


def snapshot(path):
    """Folder -> files with their sizes and times."""
    root = path.removeprefix("file:")
    return {
        folder: {(f, os.stat(os.path.join(base, f)).st_mtime_ns) for f in names if f.startswith("part-")}
        for base, _, names in os.walk(root)
        for folder in [os.path.relpath(base, root)]
        if any(f.startswith("part-") for f in names)
    }


@pytest.fixture
def table(spark):
    """Days 0 and 1 in one file each, day 2 and the null day in 12; a null measure in each."""
    path = scratch_path(spark, "days")
    day = F.when(F.col("id") % 4 < 3, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")))
    df = spark.range(4000).select(
        "id", day.alias("day"), F.when(F.col("id") % 100 > 3, F.col("id") % 10).alias("v"), F.lit("x").alias("a b")
    )
    few = F.col("day") < "2024-01-03"
    df.filter(few).coalesce(1).write.partitionBy("day").parquet(path)
    df.filter(~F.coalesce(few, F.lit(False))).repartition(12).write.partitionBy("day").mode("append").parquet(path)
    return path, sorted(df.collect(), key=lambda r: r["id"])


def stored(spark, path):
    return sorted(spark.read.parquet(path).select("id", "day", "v", "a b").collect(), key=lambda r: r["id"])


def test_only_fragmented_partitions_are_rewritten(spark, table):
    path, rows = table
    before = snapshot(path)
    report = compact_partitions(spark, path, ["day"]).first()
    assert tuple(report) == (4, 2, 26, 4)
    after = snapshot(path)
    assert {k for k in before if before[k] == after[k]} == {"day=2024-01-01", "day=2024-01-02"}
    assert {len(v) for v in after.values()} == {1}
    assert stored(spark, path) == rows
    assert compact_partitions(spark, path, ["day"]).first()["rewritten"] == 0 and snapshot(path) == after


def test_files_come_out_near_the_target(spark, table):
    path, rows = table
    sizes = [r["bytes"] for r in data_files(spark, path).filter("day = '2024-01-03'").collect()]
    target = sum(sizes) // 3
    compact_partitions(spark, path, ["day"], target_bytes=target)
    made = [r["bytes"] for r in data_files(spark, path).filter("day = '2024-01-03'").collect()]
    assert 3 <= len(made) <= 4 and max(made) <= target
    assert stored(spark, path) == rows


def test_bins(spark):
    sizes = {1: [5, 5, 4, 1, 1], 2: [30], 3: [4, 4, 4]}
    files = spark.createDataFrame([(p, f"{p}-{i}", b) for p, s in sizes.items() for i, b in enumerate(s)], "p int, file string, bytes bigint")
    found = pack_files(files, ["p"], 10).groupBy("p", "bin", "bins").agg(F.sum("bytes").alias("s")).collect()
    assert sorted((r["p"], r["bin"], r["s"], r["bins"]) for r in found) == [(1, 0, 10, 2), (1, 1, 6, 2), (2, 0, 30, 1), (3, 0, 8, 2), (3, 1, 4, 2)]


def test_bins_of_many_files(spark):
    files = spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("p"), F.concat(F.lit("f"), F.col("id")).alias("file"),
        F.pmod(F.xxhash64("id"), F.lit(30)).alias("bytes"),
    )
    found = pack_files(files, ["p"], 100, run=300)
    bins = found.groupBy("p", "bin").agg(F.sum("bytes").alias("s"), F.max("bins").alias("bins")).collect()
    assert found.select("file").distinct().count() == found.count() == 5000
    for p in (0, 1):
        mine = {r["bin"]: r["s"] for r in bins if r["p"] == p}
        assert sorted(mine) == list(range(len(mine))) and {r["bins"] for r in bins if r["p"] == p} == {len(mine)}
        assert max(mine.values()) <= 100 and len(mine) <= 2 * sum(mine.values()) / 100 + 9 + 1


def test_delete_touches_matching_partitions_only(spark, table):
    path, rows = table
    before = snapshot(path)
    report = delete_in_partitions(spark, path, "day = '2024-01-02' AND v > 4", ["day"]).collect()
    gone = [r for r in rows if str(r["day"]) == "2024-01-02" and r["v"] is not None and r["v"] > 4]
    assert [(str(r["day"]), r["deleted"], r["kept"]) for r in report] == [("2024-01-02", len(gone), 1000 - len(gone))]
    after = snapshot(path)
    assert {k for k in before if before[k] != after[k]} == {"day=2024-01-02"}
    assert stored(spark, path) == [r for r in rows if r not in gone]


def test_emptied_partitions_go_and_nulls_stay(spark, table):
    path, rows = table
    before = snapshot(path)
    delete_in_partitions(spark, path, F.col("day") == "2024-01-01", ["day"])
    after = snapshot(path)
    assert set(before) - set(after) == {"day=2024-01-01"} and all(before[k] == after[k] for k in after)
    assert stored(spark, path) == [r for r in rows if str(r["day"]) != "2024-01-01"]
    delete_in_partitions(spark, path, "v >= 0", ["day"])  # in every partition, the null one too
    assert stored(spark, path) == [r for r in rows if str(r["day"]) != "2024-01-01" and r["v"] is None]
    assert delete_in_partitions(spark, path, "id < 0", ["day"]).count() == 0


def test_null_partition(spark, table):
    path, rows = table
    report = delete_in_partitions(spark, path, "day IS NULL", ["day"]).collect()
    assert [(r["day"], r["deleted"], r["kept"]) for r in report] == [(None, 1000, 0)]
    assert stored(spark, path) == [r for r in rows if r["day"] is not None]


def test_two_partition_columns(spark):
    path = scratch_path(spark, "two")
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("a"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("int")).alias("b"))
    df.repartition(6).write.partitionBy("a", "b").parquet(path)
    assert compact_partitions(spark, path, ["a", "b"]).first()["files_after"] == 15
    before = snapshot(path)
    delete_in_partitions(spark, path, "a = 1 AND coalesce(b, 0) < 2 AND id < 500", ["a", "b"])
    after = snapshot(path)
    assert len([k for k in before if before[k] != after[k]]) == 2
    left = {r["id"] for r in spark.read.parquet(path).collect()}
    assert left == {i for i in range(1000) if not (i % 3 == 1 and i % 5 < 2 and i < 500)}
