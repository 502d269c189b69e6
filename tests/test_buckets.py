"""Bucketed layer tables: equal rows, one file for a bucket, and no exchange below joins and groupings on the key."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow import workload
from tierflow.plans import layers
from tierflow.runtime import scratch_path, session_conf
from tierflow.sinks import save_bucketed, save_layers_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, data):
    events = workload.bronze_events(spark, data)
    built = {"silver": layers.silver(events, workload.EVENTS), "rfm": layers.rfm_table(events, workload.EVENTS)}
    return built, save_layers_bucketed(spark, "bucketed_layers", scratch_path(spark, "buckets"), built, "Contract", 6)


def test_join_and_grouping_need_no_exchange(spark, stored):
    built, kept = stored
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        joined = layers.gold(kept["silver"], kept["rfm"], workload.EVENTS)
        plain = layers.gold(built["silver"], built["rfm"], workload.EVENTS)
        assert "Exchange" not in plan(joined) and "Exchange" in plan(plain) and "SelectedBucketsCount: 6 out of 6" in plan(joined)
        assert "Exchange" not in plan(kept["silver"].groupBy("Contract").agg(F.count("*")))
        assert rows(joined) == rows(plain) and joined.count() > 0


def test_files_nulls_and_replacement(spark):
    df = spark.range(0, 4000, 1, 9).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
    path = scratch_path(spark, "bucketed")
    stored = save_bucketed(df, "bucketed_rows", ["k"], 4, path)
    assert rows(stored) == rows(df) and len(stored.inputFiles()) <= 4
    again = save_bucketed(df.where("id < 10").withColumn("more", F.lit(1)), "bucketed_rows", ["k"], 2, path)
    assert again.count() == 10 and again.columns == ["k", "id", "more"] and len(again.inputFiles()) <= 2
    assert save_bucketed(df.where("id < 0"), "bucketed_rows", ["k"], 2, path).count() == 0
    spark.sql("DROP TABLE bucketed_rows")
