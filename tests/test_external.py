"""External tables, their statistics, calendar scans and zone maps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow import workload
from tierflow.runtime import delete_path, materialize, path_exists, scratch_path, session_conf
from tierflow.sinks import catalog, maintenance
from tierflow.sinks.snapshots import write_files
from tierflow.sources import on_days, read_table


@pytest.fixture
def events(spark, data):
    """Name and path of an external table of the events by date."""
    lake = workload.new_lake(spark)
    path, name = lake.table_root("events"), f"{lake.database}.events"
    write_files(workload.bronze_events(spark, data), path, partition_by=["Date"])
    catalog.ensure_database(spark, lake.database, f"{lake.base}/_catalog")
    catalog.external_table(spark, name, path, ["Date"])
    return name, path


def estimate(df):
    """The planner's row count, or None."""
    count = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(count.get())) if count.isDefined() else None


def test_statistics_reach_the_plan(spark, events):
    name, _ = events
    table = spark.table(name)
    total = table.count()
    assert estimate(table) is None
    catalog.analyze(spark, name)
    with session_conf(spark, {"spark.sql.cbo.enabled": "true"}):
        table = spark.table(name)
        assert estimate(table) == total
        assert estimate(table.filter("TotalDuration < 0")) == 0
        middle = table.agg(F.expr("(min(TotalDuration) + max(TotalDuration)) div 2")).first()[0]
        assert 0.3 * total < estimate(table.filter(F.col("TotalDuration") < middle)) < 0.7 * total


def test_column_statistics(spark, events):
    name, _ = events
    unknown = catalog.column_statistics(spark, name, ["Score"]).first()
    assert tuple(unknown) == ("Score", None, None, None, None)
    catalog.analyze(spark, name, ["Score", "AppName"])
    score, app = catalog.column_statistics(spark, name, ["Score", "AppName"]).collect()
    assert int(score["least"]) <= int(score["greatest"]) and score["nulls"] == 0
    assert app["least"] is None and 4 <= app["distinct"] <= 6


def test_partitions_follow_the_files(spark, events):
    name, path = events
    days = spark.table(name).select("Date").distinct().count()
    delete_path(spark, f"{path}/Date=2024-01-10")
    catalog.sync_partitions(spark, name)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == days - 1
    row = spark.table(name).limit(1).withColumn("Date", F.lit(dt.date(2030, 1, 1)))
    row.write.partitionBy("Date").mode("append").parquet(path)
    catalog.sync_partitions(spark, name)
    assert spark.table(name).filter("Date = DATE'2030-01-01'").count() == 1
    catalog.drop_table(spark, name)
    assert path_exists(spark, path)


def test_a_calendar_prunes_partitions_when_the_query_runs(spark, data):
    df = workload.calendar_days_scan(spark, data)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    days = {r[0] for r in df.select("Date").distinct().collect()}
    assert days and all(day.weekday() >= 5 for day in days)


def test_calendar_with_repeated_null_and_unknown_days(spark, data):
    path = scratch_path(spark, "by-date")
    rows = workload.bronze_events(spark, data)
    write_files(rows, path, partition_by=["Date"])
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, dt.date(1999, 1, 1)]
    calendar = spark.createDataFrame([(d,) for d in days], "day date")
    found = on_days(read_table(spark, path), calendar)
    assert found.count() == rows.filter("Date = DATE'2024-01-05'").count() > 0
    assert on_days(read_table(spark, path), calendar.filter("day IS NULL")).count() == 0


def test_zone_map_and_opened_share(spark):
    path = scratch_path(spark, "zones")
    frame = spark.range(0, 1600, 1, 4).select("id", F.pmod(F.xxhash64("id"), F.lit(1600)).alias("h"), F.lit(7).alias("one"),
                                              F.lit(None).cast("int").alias("none"))
    frame.write.parquet(path)
    zones = materialize(maintenance.zone_map(read_table(spark, path), ["id", "h", "one", "none"]))
    assert sorted((r["min_id"], r["max_id"], r["rows"]) for r in zones.collect()) == [(i, i + 399, 400) for i in range(0, 1600, 400)]
    found = {r["column"]: r for r in maintenance.opened_share(zones, ["id", "h", "one", "none"]).collect()}
    assert all((r["files"], r["rows"]) == (4, 1600) for r in found.values())
    # each sorted file holds 4 of 16 ranges, and may touch the next one by rounding
    assert 0.25 <= found["id"]["opened"] <= 0.32 and found["h"]["opened"] > 0.95
    assert found["one"]["opened"] == 1 / 16 and found["none"]["opened"] == 0
