"""Shape of the physical plans: one scan, pruned columns, no single-task exchange, no Python."""

import pytest
from pyspark.sql import functions as F

from tierflow import workload
from tierflow.operators import rfm
from tierflow.plans import layers
from tierflow.runtime import scratch_path
from tierflow.sinks.snapshots import write_files
from tierflow.sources import read_date_range


def plan(df):
    """The initial plan; subqueries and adaptive wrappers included."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_reads_three_columns_and_shuffles_once(spark, data):
    text = plan(workload.top3_categories(spark, data))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "Python" not in text and "SinglePartition" not in text


def test_summary_is_one_aggregation(spark, data):
    rows = workload.bronze_events(spark, data)
    text = plan(layers.summary(rows, workload.EVENTS, rfm.date_bounds(rows, "Date")))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 1 and "Join" not in text


def test_rfm_metrics_have_no_join(spark, data):
    rows = workload.bronze_events(spark, data)
    text = plan(rfm.rfm_metrics(rows, "Contract", "Date", "TotalDuration", "20240201", total_days=30))
    assert "Join" not in text and "SinglePartition" not in text and text.count("FileScan") == 1


def test_date_range_prunes_partitions(spark, data):
    path = scratch_path(spark, "by-date")
    write_files(workload.bronze_events(spark, data), path, partition_by=["Date"])
    df = read_date_range(spark, path, "2024-01-05", "2024-01-06")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(Date" in text
    assert {str(r[0]) for r in df.select("Date").distinct().collect()} == {"2024-01-05", "2024-01-06"}


def test_filters_reach_the_scan(spark, data):
    text = plan(workload.table(spark, data, "customer").filter("c_acctbal > 0").select("c_name"))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)]" in text
    assert "ReadSchema: struct<c_name:string,c_acctbal:double>" in text


# Lines with escapes go through a Python worker; both queries that read such lines are named here.
ESCAPED_LINES = ("literal_lines_parse", "player_log_job")


@pytest.mark.parametrize("name", [n for n in workload.QUERIES if n not in ESCAPED_LINES])
def test_no_python_in_the_hot_path(spark, data, name):
    if name in ("layered_run", "layered_run_applications", "zorder_keeps_rows", "compact_keeps_rows", "register_layers", "snapshot_history",
                "expired_snapshots", "maintenance_metrics", "describe_layers", "metrics_json"):
        pytest.skip("reads stored tables; the plans that wrote them are covered by the other queries")
    text = plan(workload.QUERIES[name](spark, data))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text


def test_large_lookup_is_not_broadcast(spark, data):
    from tierflow.operators import left_lookup
    from tierflow.runtime import session_conf

    events = workload.table(spark, data, "events")
    users = workload.table(spark, data, "customer")
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffled = left_lookup(events, users, "user_id", "c_custkey", ["c_name"])
        assert "Broadcast" not in plan(shuffled)
        count = shuffled.count()
    assert count == events.count()


def test_hot_key_lookup_is_split(spark):
    """Half of the rows share one key: adaptive execution splits its partition."""
    from tierflow.operators import left_lookup
    from tierflow.runtime import session_conf

    facts = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("payload")
    )
    lookup = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("key"), (F.col("id") * 2).alias("attr"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    with session_conf(spark, settings):
        joined = left_lookup(facts, lookup, "k", "key", ["attr"])
        assert len(joined.collect()) == 200_000
        assert "skew=true" in plan(joined)
