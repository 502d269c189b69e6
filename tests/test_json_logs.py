import datetime as dt
import json

import pytest
from conftest import rows

from tierflow import schemas
from tierflow.plans.config import LayerConfig
from tierflow.plans.run import create_layers, gold_layer, run
from tierflow.runtime import materialize, scratch_path
from tierflow.sinks import Lake, history, read_snapshot
from tierflow.sources import date_from_path, flatten_hits, partition_paths, read_json_logs, split_corrupt
from tierflow.sources.tables import read_date_range, read_table


def hit(contract, app, duration, n=1):
    return json.dumps({
        "_id": f"i{n}", "_index": "history", "_score": 0, "_type": "kplus",
        "_source": {"Contract": contract, "Mac": "M", "TotalDuration": duration, "AppName": app},
    })


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "logs"
    path.mkdir()
    (path / "20220401.json").write_text("\n".join([hit("a", "CHANNEL", 10), hit("b", "SPORT", 10, 2), "{bad"]) + "\n")
    (path / "20220402.json").write_text(hit("a", "VOD", 5, 3) + "\n" + hit("0", "VOD", 9, 4) + "\n")
    (path / "undated.json").write_text(hit("c", "CHILD", 1, 5) + "\n")
    (path / "notes.txt").write_text("not read")
    return str(path)


def test_flatten(spark, folder):
    good, bad = split_corrupt(materialize(flatten_hits(read_json_logs(spark, folder))))
    assert good.columns == schemas.BRONZE.fieldNames()
    assert [f.dataType for f in good.schema] == [f.dataType for f in schemas.BRONZE]
    assert rows(good, "Id", "AppName", "Contract", "TotalDuration", "Date") == sorted([
        ("i1", "CHANNEL", "a", 10, dt.date(2022, 4, 1)), ("i2", "SPORT", "b", 10, dt.date(2022, 4, 1)),
        ("i3", "VOD", "a", 5, dt.date(2022, 4, 2)), ("i4", "VOD", "0", 9, dt.date(2022, 4, 2)),
        ("i5", "CHILD", "c", 1, None),
    ], key=str)
    assert rows(bad) == [(dt.date(2022, 4, 1), "{bad")]


def test_corrupt_lines_without_the_column_are_null_rows(spark, folder):
    df = flatten_hits(read_json_logs(spark, folder, keep_corrupt=False))
    assert schemas.CORRUPT_COLUMN not in df.columns
    assert df.filter("Contract IS NULL").count() == 1


def test_inferred_schema_and_many_paths(spark, folder):
    df = flatten_hits(read_json_logs(spark, [f"{folder}/20220402.json", f"{folder}/undated.json"], schema=None))
    assert df.count() == 3 and dict(df.dtypes)["TotalDuration"] == "bigint"


def test_date_from_path(spark):
    df = spark.createDataFrame([("a/20220401.json",), ("x.json",), ("20229999.json",), ("day=20240102/p",)], "p string")
    assert [r[0] for r in df.select(date_from_path("p")).collect()] == [
        dt.date(2022, 4, 1), None, None, dt.date(2024, 1, 2)]
    assert [r[0] for r in df.select(date_from_path("p", r"day=(\d{8})")).collect()][3] == dt.date(2024, 1, 2)


def test_partition_paths_keep_the_partition_column(spark):
    path = scratch_path(spark, "days")
    df = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id AS INT)) AS Date FROM range(10)")
    df.write.partitionBy("Date").parquet(path)
    named = partition_paths(spark, path, "2024-01-03", "2024-01-05")
    assert rows(named) == rows(read_date_range(spark, path, "2024-01-03", "2024-01-05")) and named.count() == 3


def test_ignore_missing_files(spark, tmp_path):
    import glob
    import os

    path = str(tmp_path / "t")
    spark.range(0, 100, 1, 4).write.parquet(path)
    df = read_table(spark, path, ignore_missing=True)
    os.remove(sorted(glob.glob(f"{path}/part-*"))[0])
    assert df.count() == 75


def test_run_from_files_to_gold(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"), "run_files")
    config = LayerConfig(report_date="20220501")
    assert create_layers(lake) == ["run_files.bronze", "run_files.silver", "run_files.rfm", "run_files.gold"]
    assert all(spark.table(name).count() == 0 for name in ["run_files.bronze", "run_files.gold"])
    gold = run(lake, folder, config)
    expected = [
        ("a", 10, None, 5, None, None, "TV", "Movie", None, 3, 4, 4),
        ("b", None, None, None, None, 10, "Sport", None, None, 4, 3, 3),
        ("c", None, 1, None, None, None, "Child", None, None, 1, 1, 1),
    ]
    assert rows(gold) == expected
    assert rows(spark.table("run_files.gold")) == expected
    assert rows(spark.table("run_files.bronze_corrupt")) == [(dt.date(2022, 4, 1), "{bad")]
    assert spark.table("run_files.bronze").count() == 5
    assert {f.name: f.dataType for f in spark.table("run_files.rfm").schema} == {f.name: f.dataType for f in schemas.RFM}
    assert [r["operation"] for r in history(lake, "bronze").collect()] == ["overwrite", "create"]
    # The tables alone give the same gold.
    gold_layer(lake, config)
    assert rows(read_snapshot(lake, "gold")) == expected


def test_run_twice_gives_the_same_tables(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"), "run_twice")
    config = LayerConfig(report_date="20220501")
    first = rows(run(lake, folder, config, cluster=False))
    assert rows(run(lake, folder, config)) == first
    assert lake.snapshot("gold").version == 2


def test_command_line(spark, folder, monkeypatch):
    from tierflow import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    monkeypatch.setattr(cli, "clear_scratch", lambda session: None)
    root = scratch_path(spark, "lake")
    base = ["--lake", root, "--database", "cli"]
    cli.main([*base, "create"])
    assert spark.table("cli.gold").count() == 0
    cli.main([*base, "run", "--raw", folder, "--report-date", "2022-05-01", "--population", "usable", "--total-days", "30"])
    assert spark.table("cli.gold").count() == 3
    cli.main([*base, "vacuum", "gold", "--retention-days", "0"])
    assert read_snapshot(Lake(spark, root), "gold").count() == 3
    with pytest.raises(LookupError):
        read_snapshot(Lake(spark, root), "gold", version=1)
