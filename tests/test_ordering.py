import bisect

import pytest
from pyspark.sql import functions as F

from tierflow.functions.ordering import quantile_cuts, spread_bits, with_rank, with_z_value
from tierflow.runtime import materialize
from tierflow.sinks.snapshots import clustered


@pytest.mark.parametrize("cuts", [[], [5], [1, 5, 9], list(range(0, 300, 3))])
def test_rank_counts_cuts(spark, cuts):
    df = spark.range(-5, 310).select(F.when(F.col("id") != 7, F.col("id")).alias("v"))
    out = with_rank(df, "v", cuts, "r")
    assert out.columns == ["v", "r"]
    assert all(r["r"] == (0 if r["v"] is None else bisect.bisect_right(cuts, r["v"])) for r in out.collect())


def test_rank_of_text(spark):
    df = spark.createDataFrame([("a",), ("b",), ("bb",), ("z",), (None,)], "v string")
    assert [r["r"] for r in with_rank(df, "v", ["b", "c"], "r").collect()] == [0, 1, 1, 2, 0]


def test_spread_bits():
    assert spread_bits(0b1011, 2, 0) == 0b1000101 and spread_bits(0b11, 3, 1) == 0b10010


def test_z_value_interleaves_ranks(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    out = with_z_value(df, ["a", "b"], 3, 64, "z").collect()
    assert {r["z"] for r in out} == set(range(64))
    assert all(r["z"] == spread_bits(r["a"], 2, 0) + spread_bits(r["b"], 2, 1) for r in out)


def test_z_value_limits(spark):
    with pytest.raises(ValueError):
        with_z_value(spark.range(1), ["id"], 11, 1, "z")


def test_cuts_of_nulls_and_few_values(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) n, id % 2 b FROM range(100)")
    assert quantile_cuts(df, ["n", "b"], 8, 100) == {"n": [], "b": [0, 1]}


def test_clustered_parts_are_ordered_and_even(spark):
    """A value with a third of all rows is spread, and no part reaches into the next one."""
    df = materialize(spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"), "id",
    ))
    out = clustered(df, ["v"], 12, 20_000)
    assert out.columns == ["v", "id"]
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("p").collect()
    assert [r["p"] for r in parts] == list(range(12)) and sum(r["n"] for r in parts) == 20_000
    assert max(r["n"] for r in parts) < 2 * 20_000 / 12
    edges = [(r["lo"], r["hi"]) for r in parts]
    assert all(left[1] <= right[0] for left, right in zip(edges, edges[1:]))
    assert out.agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_cells_of_a_coarse_curve_are_cut_by_the_columns(spark):
    df = materialize(spark.range(0, 8_000, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b")))
    out = clustered(df, ["a", "b"], 32, 8_000, bits=1)
    spans = out.groupBy(F.spark_partition_id().alias("p")).agg((F.max("a") - F.min("a")).alias("a"), F.count(F.lit(1)).alias("n")).collect()
    assert len(spans) == 32 and max(r["n"] for r in spans) < 500
    assert sum(r["a"] for r in spans) / 32 < 150  # four cells alone leave spans of 500


def test_clustering_an_empty_frame(spark):
    assert clustered(materialize(spark.range(0)), ["id"], 4, 0).count() == 0
