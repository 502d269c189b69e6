import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators.ranking import ntile_exact, ntiles_exact
from tierflow.operators.rfm import score


def windowed(df, buckets, value, key, groups=()):
    window = Window.partitionBy(*groups).orderBy(F.col(value).asc_nulls_first(), F.col(key).asc())
    return df.withColumn("b", F.ntile(buckets).over(window))


def same(left, right):
    assert left.columns == right.columns and left.dtypes == right.dtypes
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def sample(kind, rows=1003, seed=3):
    draw = random.Random(seed)
    values = {
        "ties": lambda i: draw.choice([None, 1, 1, 1, 2, 5]),
        "null": lambda i: None,
        "distinct": lambda i: i * 7919 % 10007,
        "one_value": lambda i: 4,
    }[kind]
    return [(values(i), f"k{draw.random():.12f}-{i}") for i in range(rows)]


@pytest.mark.parametrize("kind", ["ties", "null", "distinct", "one_value"])
@pytest.mark.parametrize("buckets", [3, 10])
def test_global_equals_window(spark, kind, buckets):
    df = spark.createDataFrame(sample(kind), "v int, k string").repartition(5)
    same(ntile_exact(df, buckets, "v", "k", "b"), windowed(df, buckets, "v", "k"))


@pytest.mark.parametrize("rows", [1, 3, 4, 5])
def test_fewer_rows_than_buckets(spark, rows):
    df = spark.createDataFrame([(i, str(i)) for i in range(rows)], "v int, k string")
    same(ntile_exact(df, 4, "v", "k", "b"), windowed(df, 4, "v", "k"))


def test_empty(spark):
    df = spark.createDataFrame([], "v int, k string")
    assert ntile_exact(df, 4, "v", "k", "b").count() == 0


@pytest.mark.parametrize("dtype,cast", [
    ("double", lambda i: (i % 37 - 18) / 7 if i % 11 else float("nan")),
    ("bigint", lambda i: 2**60 + i % 5),
    ("date", lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i % 9)),
    ("timestamp_ntz", lambda i: dt.datetime(2024, 1, 1, 0, 0, 0, i % 13)),
    ("decimal(12,2)", lambda i: Decimal(i % 17) / 4),
    ("string", lambda i: "xyzé"[i % 4] * (i % 3)),
])
def test_value_types(spark, dtype, cast):
    df = spark.createDataFrame([(cast(i), i) for i in range(400)], f"v {dtype}, k bigint")
    same(ntile_exact(df, 4, "v", "k", "b"), windowed(df, 4, "v", "k"))


def test_hot_group_and_null_group(spark):
    rows = [(v, k, "hot" if i % 3 else (None if i % 2 else f"g{i % 40}")) for i, (v, k) in enumerate(sample("ties"))]
    df = spark.createDataFrame(rows, "v int, k string, g string").repartition(4)
    out = ntile_exact(df, 4, "v", "k", "b", partition_by=["g"])
    same(out, windowed(df, 4, "v", "k", ["g"]))


def test_two_group_columns(spark):
    rows = [(v, k, i % 2, "ab"[i % 2]) for i, (v, k) in enumerate(sample("distinct"))]
    df = spark.createDataFrame(rows, "v int, k string, g int, h string")
    same(ntile_exact(df, 5, "v", "k", "b", ["g", "h"]), windowed(df, 5, "v", "k", ["g", "h"]))


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(sample("ties"), "v int, k string")
    same(
        ntile_exact(df.repartition(1), 4, "v", "k", "b"),
        ntile_exact(df.repartition(7), 4, "v", "k", "b"),
    )


def test_ranges_that_end_in_different_rounds(spark):
    """Most rows share one value: its range takes more rounds than the ranges on both sides."""
    df = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") % 10 < 8, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).cast("int").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("k"),
    )
    same(ntile_exact(df, 20, "v", "k", "b"), windowed(df, 20, "v", "k"))


def test_several_columns_at_once(spark):
    df = spark.createDataFrame([(v, -(v or 0) * 1.5, k) for v, k in sample("ties")], "v int, w double, k string")
    out = ntiles_exact(df, 4, {"a": "v", "c": "w"}, "k")
    one = ntile_exact(ntile_exact(df, 4, "v", "k", "a"), 4, "w", "k", "c")
    same(out, one)


def test_equal_rows_fill_buckets_like_the_window(spark):
    df = spark.createDataFrame([(i % 3, "same") for i in range(1000)], "v int, k string").repartition(8)
    sizes = {r["b"]: r["count"] for r in ntile_exact(df, 4, "v", "k", "b").groupBy("b").count().collect()}
    assert sizes == {1: 250, 2: 250, 3: 250, 4: 250}


def test_no_task_gets_all_rows_and_nothing_is_broadcast_by_force(spark):
    df = spark.createDataFrame(sample("ties"), "v int, k string")
    out = ntile_exact(df, 4, "v", "k", "b")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_inverted_recency(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 3), ("b", 5, 1.0, 9), ("c", 9, 9.0, 1)],
                               "Contract string, Recency int, Frequency double, MonetaryDuration bigint")
    plain = {r["Contract"]: r["RecencyScore"] for r in score(df, "Contract", 3).collect()}
    inverted = {r["Contract"]: r["RecencyScore"] for r in score(df, "Contract", 3, invert_recency=True).collect()}
    assert plain == {"a": 1, "b": 2, "c": 3} and inverted == {"a": 3, "b": 2, "c": 1}
