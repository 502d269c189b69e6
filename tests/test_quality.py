import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators import RULES, ColumnRule, QualityError, TableRules, check, enforce
from tierflow.operators.quality import audit, split
from tierflow.runtime import path_exists, scratch_path
from tierflow.sinks import Lake, publish, read_snapshot

RULE = TableRules("t", (
    ColumnRule("k", T.StringType(), nullable=False),
    ColumnRule("s", T.IntegerType(), minimum=1, maximum=4),
))
ROWS = [("a", 1), ("b", 5), (None, 0), ("c", None), ("d", 4)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, "k string, s int")


def test_report_counts_each_rule(frame):
    assert rows(check(frame, RULE)) == sorted([
        ("t", "k", "type", 0, 5), ("t", "k", "not_null", 1, 5), ("t", "s", "type", 0, 5), ("t", "s", "in_range", 2, 5),
    ], key=str)


def test_report_is_one_scan(frame):
    text = check(frame, RULE)._jdf.queryExecution().executedPlan().toString()
    assert text.count("ExistingRDD") + text.count("LocalTableScan") == 1


def test_missing_and_wrongly_typed_columns_fail_every_row(spark):
    df = spark.createDataFrame([("a", "x")], "k string, s string")
    assert audit(df, RULE).failures == [("s", "type", 1)]
    assert audit(df.drop("s"), RULE).failures == [("s", "present", 1)]
    for policy in ("warn", "quarantine", "fail"):
        with pytest.raises(QualityError):
            enforce(df, RULE, policy)


def test_policies(frame):
    with pytest.raises(QualityError, match="in_range: 2 rows"):
        enforce(frame, RULE)
    kept, bad, found = enforce(frame, RULE, "warn")
    assert kept is frame and bad is None and len(found.failures) == 2 and found.rows == 5
    kept, bad, _ = enforce(frame, RULE, "quarantine")
    assert rows(kept) == sorted([("a", 1), ("c", None), ("d", 4)], key=str)
    assert rows(bad) == sorted([("b", 5, ["s:in_range"]), (None, 0, ["k:not_null", "s:in_range"])], key=str)
    with pytest.raises(ValueError):
        enforce(frame, RULE, "ignore")


def test_split_is_a_partition_of_the_rows(frame):
    good, bad = split(frame, RULE)
    assert good.count() + bad.count() == len(ROWS)


def test_empty_frame_passes(spark):
    empty = spark.createDataFrame([], "k string, s int")
    assert audit(empty, RULE).failures == [] and audit(empty, RULE).rows == 0
    with pytest.raises(QualityError):
        enforce(empty.drop("s"), RULE)


def test_failed_audit_leaves_the_table_as_it_was(spark, frame):
    lake = Lake(spark, scratch_path(spark, "lake"), "audit")
    publish(lake, frame.filter("s = 1"), "t", rules=RULE)
    with pytest.raises(QualityError):
        publish(lake, frame, "t", rules=RULE)
    assert rows(read_snapshot(lake, "t")) == [("a", 1)] and rows(spark.table("audit.t")) == [("a", 1)]
    assert lake.snapshot("t").version == 1
    # The next publish takes the place of the rejected one.
    publish(lake, frame.filter("s = 4"), "t", rules=RULE)
    assert rows(spark.table("audit.t")) == [("d", 4)]


def test_quarantine_with_clustering(spark, frame):
    from tierflow.sinks import Layout

    lake = Lake(spark, scratch_path(spark, "lake"), "quarantined")
    publish(lake, frame, "t", rules=RULE, policy="quarantine", layout=Layout(cluster_by=("k",)))
    assert rows(spark.table("quarantined.t")) == sorted([("a", 1), ("c", None), ("d", 4)], key=str)
    assert spark.table("quarantined.t_quarantine").count() == 2


def test_registry_has_every_layer():
    assert set(RULES) == {"bronze", "silver", "rfm", "gold", "pivot"}
    scores = [c for c in RULES["gold"].columns if c.minimum is not None]
    assert [(c.name, c.minimum, c.maximum) for c in scores] == [
        ("RecencyScore", 1, 4), ("FrequencyScore", 1, 4), ("MonetaryDurationScore", 1, 4)]


def test_quarantine_follows_the_mode_of_its_table(spark, frame):
    lake = Lake(spark, scratch_path(spark, "lake"), "quarantine_modes")

    def count():
        return spark.table("quarantine_modes.t_quarantine").count()

    publish(lake, frame, "t", rules=RULE, policy="quarantine")
    once = count()
    publish(lake, frame, "t", rules=RULE, policy="quarantine", append=True)
    assert count() == 2 * once > 0
    good = spark.table("quarantine_modes.t").limit(1)
    publish(lake, spark.createDataFrame(good.collect(), good.schema), "t", rules=RULE, policy="quarantine")
    assert count() == 0


def test_publish_counts_rules_while_writing(spark, tmp_path, monkeypatch):
    """No scan for the audit: neither of the input nor of the files. Good tables, bad ones and empty ones alike."""
    from tierflow.operators import quality
    from tierflow.sinks import Lake, Layout, publish

    reads = spark.sparkContext.accumulator(0)

    def once(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    plain = spark.range(0, 1000, 1, 7).selectExpr("id", "CAST(id % 3 AS INT) AS part", "IF(id % 10 = 0, NULL, id) AS v")
    rows_in = plain.mapInArrow(once, "id long, part int, v long")
    rules = quality.TableRules.from_schema("t", rows_in.schema, ranges={"id": (0, 900)}, required=("v",))
    want = {(r["column"], r["rule"]): r["failures"] for r in quality.check(plain, rules).collect()}
    lake = Lake(spark, str(tmp_path / "lake"), database="audited")
    with monkeypatch.context() as patch:
        patch.setattr(quality, "audit", lambda *_: pytest.fail("the audit read the table again"))
        for layout in (None, Layout(compact=True)):
            with pytest.raises(quality.QualityError) as error:
                publish(lake, rows_in, "t", rules=rules, partition_by=["part"], layout=layout)
            assert {(c, r): n for c, r, n in error.value.failures} == {k: n for k, n in want.items() if n}
        assert lake.snapshot("t") is None
        reads.value = 0
        assert publish(lake, rows_in, "t", rules=rules, policy="warn", partition_by=["part"]).rows == 1000
        assert reads.value == 1000
        good = quality.TableRules.from_schema("t", rows_in.schema, ranges={"id": (0, 1000)})
        assert publish(lake, rows_in, "t", rules=good).rows == 1000
    assert publish(lake, plain.where("id < 0"), "t", rules=rules).rows == 0


@pytest.mark.parametrize("partition_by", [(), ("k",)])
def test_quarantine_writes_valid_rows_once(spark, partition_by):
    """The job that writes the files parts the rows; no second job writes the valid ones."""
    lake = Lake(spark, scratch_path(spark, "lake"), "quarantine_once")
    frame = spark.range(0, 400, 1, 4).select((F.col("id") % 3).cast("int").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("v"))
    rules = TableRules("t", (ColumnRule("v", T.LongType(), nullable=False),))
    table = f"t{len(partition_by)}"
    done = publish(lake, frame, table, rules=rules, policy="quarantine", partition_by=partition_by)
    assert done.rows == 360 and done.paths[0].endswith("/__kept=true") and not path_exists(spark, done.paths[0].replace("true", "false"))
    read = spark.table(f"quarantine_once.{table}")
    assert sorted(read.columns) == ["k", "v"] and read.agg(F.count("*"), F.count("v"), F.sum("v")).first()[:] == (360, 360, sum(i for i in range(400) if i % 10))
    bad = spark.table(f"quarantine_once.{table}_quarantine")
    assert bad.count() == 40 and {tuple(r[0]) for r in bad.select("broken_rules").collect()} == {("v:not_null",)}
    if not partition_by:  # one file of valid rows per task: no exchange, no sort
        assert done.files == 4


def test_quarantine_of_all_rows_or_none(spark):
    lake = Lake(spark, scratch_path(spark, "lake"), "quarantine_ends")
    rules = TableRules("t", (ColumnRule("v", T.LongType(), nullable=False),))
    frame = spark.range(5).select(F.col("id").alias("v"))
    for name, rows, kept, bad in (("none", frame, 5, 0), ("all", frame.select(F.lit(None).cast("long").alias("v")), 0, 5), ("empty", frame.limit(0), 0, 0)):
        assert publish(lake, rows, name, rules=rules, policy="quarantine").rows == kept
        assert spark.table(f"quarantine_ends.{name}").count() == kept
        if bad:
            assert spark.table(f"quarantine_ends.{name}_quarantine").count() == bad
    publish(lake, frame, "all", rules=rules, policy="quarantine", append=True)
    assert spark.table("quarantine_ends.all").count() == 5 and spark.table("quarantine_ends.all_quarantine").count() == 5
    with pytest.raises(ValueError):
        publish(lake, frame.withColumn("__kept", F.lit(1)), "odd", rules=rules, policy="quarantine")
