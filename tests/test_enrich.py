"""The hot-key lookup equals the plain one, and deals a hot key over several tasks without any session setting."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow.operators import hot_key_lookup, left_lookup
from tierflow.operators.enrich import hot_keys
from tierflow.runtime import session_conf


@pytest.fixture(scope="module")
def facts(spark):
    """A third on one key, a third without a key, and some rows that are there twice."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 500 + 1000)
    once = spark.range(0, 9000, 1, 6).select(key.alias("k"), F.col("id").alias("payload"), F.lit("x").alias("attr_left"))
    return once.union(once.where("payload < 30"))


@pytest.fixture(scope="module")
def lookup(spark):
    """Key 7 has two rows, some keys have none, and one row has no key."""
    found = spark.range(0, 1400).select(F.col("id").alias("key"), (F.col("id") * 2).alias("attr"), F.lit("y").alias("more"))
    return found.union(spark.createDataFrame([(7, -1, "z"), (None, -2, "z")], "key long, attr long, more string"))


def test_hot_keys_are_found(facts):
    assert dict(hot_keys(facts, "k", 500)) == {7: 7, None: 7} and hot_keys(facts, "k", 100_000) == []
    assert set(dict(hot_keys(facts, "k"))) == {7, None}


@pytest.mark.parametrize("task_rows", [None, 50, 100_000])
def test_equals_plain_lookup(facts, lookup, task_rows):
    for columns in (None, ["attr"], ["key", "attr"]):
        plain = left_lookup(facts, lookup, "k", "key", columns)
        salted = hot_key_lookup(facts, lookup, "k", "key", columns, task_rows)
        assert salted.columns == plain.columns and rows(salted) == rows(plain)


def test_text_keys_and_empty_tables(spark, facts, lookup):
    named = facts.withColumn("k", F.concat(F.lit("k"), F.col("k").cast("string")))
    text = lookup.withColumn("key", F.concat(F.lit("k"), F.col("key").cast("string")))
    assert rows(hot_key_lookup(named, text, "k", "key", ["attr"], 200)) == rows(left_lookup(named, text, "k", "key", ["attr"]))
    assert hot_key_lookup(facts.where("payload < 0"), lookup, "k", "key").count() == 0
    assert hot_key_lookup(facts, lookup.where("key < 0"), "k", "key", ["attr"], 200).where("attr IS NOT NULL").count() == 0


def test_no_task_takes_the_hot_key_alone(facts, lookup):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    with session_conf(facts.sparkSession, settings):
        def most(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain, salted = most(left_lookup(facts, lookup, "k", "key")), most(hot_key_lookup(facts, lookup, "k", "key"))
    assert plain >= 3000 and salted <= plain / 2
