import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow import schemas
from tierflow.functions.days import day_sets, days_in_all, days_in_sets, lists_days
from tierflow.functions.recode import add_category, first_wins, recode, usable_rows
from tierflow.operators import argmax_column, conditional_pivot, rfm
from tierflow.operators.pivot import category_pivot, grouped_pivot
from tierflow.plans import layers
from tierflow.plans.config import APP_NAMES, COLUMN_NAMES, LayerConfig
from tierflow.runtime import materialize

CONFIG = LayerConfig(report_date="20220501")

D1, D2, D3 = dt.date(2022, 4, 1), dt.date(2022, 4, 2), dt.date(2022, 4, 3)
EDGE = [
    ("a", 10, D1, "CHANNEL"),
    ("a", 5, D2, "VOD"),
    ("b", 10, D1, "SPORT"),
    ("b", 10, D1, "CHILD"),
    ("c", 0, D2, "RELAX"),
    ("d", 7, D3, "ZZZ"),
    (None, 3, D3, "VOD"),
    ("0", 3, None, "VOD"),
    ("", 4, D3, "KPLUS"),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "Contract string, TotalDuration bigint, Date date, AppName string")
    return materialize(df)


def test_silver(edge):
    assert rows(layers.silver(edge, CONFIG)) == rows_of(
        ("", 4, None, None, None, None, "TV", None, None),
        ("a", 10, None, 5, None, None, "TV", "Movie", None),
        ("b", None, 10, None, None, 10, "Sport", "Child", None),
    )


def rows_of(*values):
    return sorted(values, key=str)


def test_silver_schema(edge):
    assert [(f.name, f.dataType) for f in layers.silver(edge, CONFIG).schema] == [
        (f.name, f.dataType) for f in schemas.SILVER
    ]


def test_argmax_takes_the_first_of_equals(edge):
    silver = layers.silver(edge, CONFIG)
    out = silver.select("Contract", argmax_column(CONFIG.ranked).alias("m"))
    assert rows(out) == rows_of(("", "TV"), ("a", "TV"), ("b", "Child"))


def test_argmax_of_nulls_is_the_first_label(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) a, CAST(NULL AS INT) b")
    assert df.select(argmax_column({"a": "A", "b": "B"})).first()[0] == "A"
    assert df.select(argmax_column({"a": "A"})).first()[0] == "A"


RFM_ROWS = [
    ("", 28, 33.33, 4, 1, 1, 2),
    ("0", None, 0.0, 3, 1, 1, 1),
    ("a", 29, 66.67, 15, 2, 4, 3),
    ("b", 30, 33.33, 20, 4, 2, 4),
    ("c", 29, 33.33, 0, 3, 2, 1),
    ("d", 28, 33.33, 7, 2, 3, 2),
]


def test_rfm(edge):
    assert rows(layers.rfm_table(edge, CONFIG)) == rows_of(*RFM_ROWS)


def test_rfm_with_stated_period(edge):
    assert rows(layers.rfm_table(edge, CONFIG, (D1, D3))) == rows_of(*RFM_ROWS)


def test_rfm_schema(edge):
    assert [(f.name, f.dataType) for f in layers.rfm_table(edge, CONFIG).schema] == [
        (f.name, f.dataType) for f in schemas.RFM
    ]


def test_rfm_with_selected_bucket_ends(edge):
    assert rows(layers.rfm_table(edge, CONFIG)) == rows_of(*RFM_ROWS)


def test_rfm_of_usable_rows(edge):
    out = layers.rfm_table(edge, replace(CONFIG, population="usable", total_days=30))
    assert rows(out.select("Contract", "Recency", "Frequency", "MonetaryDuration")) == rows_of(
        ("a", 29, 6.67, 15), ("b", 30, 3.33, 20), ("d", 28, 3.33, 7)
    )


def test_scores_within_the_key_are_all_one(edge):
    out = layers.rfm_table(edge, replace(CONFIG, buckets=3, score_within=("Contract",)))
    assert {tuple(r) for r in out.select(*rfm.SCORES).collect()} == {(1, 1, 1)}


def test_dates_outside_the_stated_period_raise(edge):
    with pytest.raises(Exception, match="date outside"):
        rfm.rfm_metrics(edge, "Contract", "Date", "TotalDuration", "20220501", period=(D1, D2)).collect()


def test_period_without_dates(spark):
    df = spark.createDataFrame([("a", 1, None)], "Contract string, TotalDuration bigint, Date date")
    assert rfm.period_days(df, "Date").first()[0] == 0 and rfm.date_bounds(df, "Date") is None
    out = rfm.rfm_metrics(df, "Contract", "Date", "TotalDuration", "20220501").first()
    assert tuple(out) == ("a", None, None, 1)


@pytest.mark.parametrize("days", [1, 62, 63, 64, 126, 127, 500, 504, 505, 2400, 32768, 70000])
def test_day_bits_equal_distinct_count(spark, days):
    first = dt.date(1904, 1, 1)
    last = first + dt.timedelta(days=days - 1)
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("Contract"),
        F.when(F.col("id") % 11 != 0, F.date_add(F.lit(first), (F.pmod(F.xxhash64("id"), F.lit(days))).cast("int"))).alias("Date"),
        F.lit(1).cast("bigint").alias("TotalDuration"),
    )
    args = (df, "Contract", "Date", "TotalDuration", "20260101")
    assert rows(rfm.rfm_metrics(*args, period=(first, last))) == rows(rfm.rfm_metrics(*args))


@pytest.mark.parametrize("years", [0, 4, 200])
def test_a_date_outside_the_period_is_an_error(spark, years):
    """For short and long periods alike."""
    first, last = dt.date(1904, 1, 1), dt.date(1904 + years, 1, 31)
    df = spark.createDataFrame([("a", 1, last), ("a", 1, None), ("a", 1, last + dt.timedelta(days=1))], "Contract string, TotalDuration bigint, Date date")
    inside = df.where(F.col("Date").isNull() | (F.col("Date") == F.lit(last)))
    assert rows(rfm.activeness(inside, "Contract", "Date", 1.0, period=(first, last))) == [("a", 1.0)]
    with pytest.raises(Exception, match="date outside"):
        rfm.activeness(df, "Contract", "Date", period=(first, last)).collect()


def test_long_periods_need_one_exchange_and_merge(spark, edge):
    period = (dt.date(1950, 1, 1), dt.date(2030, 1, 1))
    counted = rfm.activeness(edge, "Contract", "Date", period=period)
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    joined = layers.gold(layers.silver(edge, CONFIG), layers.rfm_table(edge, CONFIG), CONFIG)
    assert rows(layers.gold_of(layers.profile(edge, CONFIG, period), CONFIG)) == rows(joined)


def test_sets_of_a_long_period_hold_only_the_days_of_their_group(spark):
    """Their size follows the group's rows; fixed bitmaps took 4,096 bytes for each group, in every task that met it."""
    first, last = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
    df = spark.range(600).select((F.col("id") % 300).alias("k"), F.date_add(F.lit(first), (F.col("id") * 4).cast("int")).alias("d"))
    sets = day_sets(F.col("d"), first, last)
    held = df.groupBy("k").agg(*[one.alias(f"s{i}") for i, one in enumerate(sets)])
    assert {len(r["s0"]) for r in held.collect()} == {2} and len(sets) == 1
    assert days_in_all(held, ["s0"], lists_days(first, last)).first()["n"] == 600
    assert rows(held.select(days_in_sets([F.col("s0")], True).alias("n")).distinct()) == [(2,)]


def test_gold_from_profile_equals_join(edge):
    period = rfm.date_bounds(edge, "Date")
    profiled = layers.profile(edge, CONFIG, period)
    joined = layers.gold(layers.silver(edge, CONFIG), layers.rfm_table(edge, CONFIG), CONFIG)
    assert rows(layers.gold_of(profiled, CONFIG)) == rows(joined)
    assert rows(layers.silver_of(profiled, CONFIG)) == rows(layers.silver(edge, CONFIG))
    assert rows(layers.rfm_of(profiled, CONFIG)) == rows_of(*RFM_ROWS)
    assert rows(layers.rfm_of(layers.profile(edge, CONFIG), CONFIG)) == rows_of(*RFM_ROWS)


def test_usable_population_is_the_same_in_both_forms(edge):
    config = replace(CONFIG, population="usable")
    profiled = layers.profile(edge, config, rfm.date_bounds(edge, "Date"))
    assert rows(layers.silver_of(profiled, config)) == rows(layers.silver(edge, config))
    assert rows(layers.rfm_of(profiled, config)) == rows(layers.rfm_table(edge, config))
    joined = layers.gold(layers.silver(edge, config), layers.rfm_table(edge, config), config)
    assert rows(layers.gold_of(profiled, config)) == rows(joined)
    assert sorted(r["Contract"] for r in layers.rfm_of(profiled, config).collect()) == ["a", "b", "d"]


def test_conditional_pivot_keeps_every_key(edge):
    out = conditional_pivot(edge.filter("Contract IS NOT NULL"), "Contract", "AppName", "TotalDuration", CONFIG.targets)
    assert rows(out) == rows_of(
        ("", 4, 0, 0, 0, 0),
        ("0", 0, 0, 3, 0, 0),
        ("a", 10, 0, 5, 0, 0),
        ("b", 0, 10, 0, 0, 10),
        ("c", 0, 0, 0, 0, 0),
        ("d", 0, 0, 0, 0, 0),
    )


def test_conditional_pivot_is_the_filled_pivot(edge):
    raw = grouped_pivot(edge, "Contract", "AppName", "TotalDuration", CONFIG.targets).na.fill(0)
    assert rows(raw) == rows(conditional_pivot(edge, "Contract", "AppName", "TotalDuration", CONFIG.targets))


def test_pivot_equals_built_in_pivot(edge):
    typed = layers.categorized(edge, CONFIG)
    built_in = typed.groupBy("Contract").pivot("Type", list(CONFIG.columns)).sum("TotalDuration")
    assert rows(built_in) == rows(category_pivot(typed, "Contract", "Type", "TotalDuration", CONFIG.columns))


def test_recode_first_wins_and_default(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    mapping = first_wins(["x", "y", "x"], ["1", "2", "3"])
    expected = [("1",), ("2",), ("Unknown",), ("Unknown",)]
    assert [tuple(r) for r in df.select(recode("c", mapping)).collect()] == expected
    assert [tuple(r) for r in df.select(recode("c", {})).collect()] == [("Unknown",)] * 4
    assert [tuple(r) for r in df.select(recode("c", mapping, "")).collect()][2] == ("",)


def test_recode_lengths_must_match():
    with pytest.raises(ValueError):
        first_wins(["a"], [])


def test_large_mapping_is_joined(spark):
    mapping = {f"s{i}": f"t{i % 3}" for i in range(500)}
    df = spark.createDataFrame([("s4",), ("s499",), ("no",), (None,)], "c string")
    out = add_category(df, "c", mapping)
    assert rows(out) == rows_of(("s4", "t1"), ("s499", "t1"), ("no", "Unknown"), (None, "Unknown"))


def test_usable_rows_drop_nulls(edge):
    predicate = usable_rows("Contract", ("0", ""), measure="TotalDuration")
    assert sorted(r[0] for r in edge.filter(predicate).select("Contract").distinct().collect()) == ["a", "b", "d"]


def test_activeness_is_float(edge):
    out = rfm.activeness(edge.filter("Contract = 'a'"), "Contract", "Date")
    assert dict(out.dtypes)["Activeness"] == "float" and out.first()[1] == pytest.approx(2 / 30)


def test_rfm_code(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 1), (None, 1, 1)], "RecencyScore int, FrequencyScore int, MonetaryDurationScore int")
    coded = df.select(rfm.rfm_code().alias("code"))
    assert [r[0] for r in coded.collect()] == ["123", "111", None]
    assert [r[0] for r in coded.filter(rfm.exclude_code("code")).collect()] == ["123"]


def test_default_mapping():
    assert first_wins(APP_NAMES, COLUMN_NAMES)["BHD"] == "MovieDuration"
    assert CONFIG.targets["TVDuration"] == ["CHANNEL", "KPLUS"]


def test_other_key_buckets_and_groups(spark, edge):
    from tierflow.sinks import Lake
    from tierflow.plans.run import gold_layer, profile_bronze, silver_layer
    from tierflow.runtime import scratch_path
    from tierflow.sinks.snapshots import publish

    lake = Lake(spark, scratch_path(spark, "lake"), "other_config")
    config = replace(CONFIG, key="Mac", buckets=10, score_within=("Contract",))
    known = {"AppName", "Contract", "TotalDuration", "Date"}
    rows_ = edge.select(*[c for c in edge.columns if c in known], F.concat(F.lit("m"), F.monotonically_increasing_id().cast("string")).alias("Mac"))
    publish(lake, rows_, "bronze")
    profiled, _ = profile_bronze(lake, config)
    silver_layer(lake, config, profiled)
    gold_layer(lake, config, profiled)
    assert spark.table("other_config.gold").columns[0] == "Mac" and spark.table("other_config.rfm").count() == edge.count()
