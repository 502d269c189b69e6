"""Inference over stored variants: shapes, conflicts, broken lines, one read."""

import json

import pytest
from pyspark.sql import types as T

from tierflow.runtime import delete_path, scratch_path
from tierflow.sources.json_variant import infer_json_lines, store_variants, variant_type, widened


def lines(spark, texts):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(t,) for t in texts], "value string").repartition(3).write.text(path)
    return path


def read(spark, texts, **options):
    return infer_json_lines(spark, lines(spark, texts), glob=None, **options)


def test_differing_shapes_are_merged(spark):
    df = read(spark, [
        '{"id": 1, "v": 5, "o": {"a": 1}}',
        '{"id": 2, "v": "x", "o": {"b": [1, 2.5]}}',
        '{"id": 3, "v": {"k": [1]}, "extra": null}',
        '{"id": 4, "v": null, "o": {"a": 2, "b": []}}',
    ])
    kinds = dict(df.drop("__path", "_corrupt_record").dtypes)
    assert kinds == {"id": "bigint", "v": "string", "extra": "string", "o": "struct<a:bigint,b:array<double>>"}
    found = {r["id"]: r for r in df.collect()}
    assert [found[i]["v"] for i in (1, 2, 3, 4)] == ["5", "x", '{"k":[1]}', None]
    assert found[2]["o"]["b"] == [1.0, 2.5] and found[2]["o"]["a"] is None and found[3]["o"] is None


def test_numbers_widen(spark):
    texts = ['{"n": 1, "m": 1}', '{"n": 2.25, "m": 12345678901234567890123}']
    assert dict(read(spark, texts).dtypes)["n"] == "double"
    exact = read(spark, texts, exact_decimals=True)
    assert dict(exact.dtypes)["m"] == "decimal(23,0)" and dict(exact.dtypes)["n"].startswith("decimal")


def test_broken_lines_are_kept_and_blank_ones_left_out(spark):
    broken = ['{"id": 1', "[1, 2]", "7", '{"id": 1, "id": 2}', "word"]
    df = read(spark, ['{"id": 1}', "", "   ", *broken])
    assert dict(df.dtypes)["id"] == "bigint"
    assert sorted(r[0] for r in df.select("_corrupt_record").collect() if r[0]) == sorted(broken)
    assert df.count() == 6


def test_odd_names(spark):
    names = ["a.b", "it's", 'say "x"', "OBJECT<", "tick`s", "ü", "with space", "back\\slash"]
    df = read(spark, [json.dumps({name: i for i, name in enumerate(names)}, ensure_ascii=False)])
    assert {name: df.first()[name] for name in names} == {name: i for i, name in enumerate(names)}


def test_names_that_differ_by_case_raise(spark):
    with pytest.raises(ValueError, match="differ by case"):
        read(spark, ['{"o": [{"id": 1}]}', '{"o": [{"ID": 2}]}'])


def test_reserved_and_clashing_columns_raise(spark):
    frame = spark.createDataFrame([('{"a": 1}', 1)], "value string, __record int")
    with pytest.raises(ValueError, match="reserved"):
        store_variants(frame)
    with pytest.raises(ValueError, match="share names"):
        read(spark, ['{"__path": 1}'])


def test_no_lines_and_no_objects(spark):
    assert read(spark, []).columns == ["_corrupt_record", "__path"] or read(spark, []).count() == 0
    df = read(spark, ["1", "[]"])
    assert set(df.columns) == {"_corrupt_record", "__path"} and df.count() == 2


def test_files_are_read_once(spark):
    path = lines(spark, ['{"id": 1}', '{"id": 2}'])
    df = infer_json_lines(spark, path, glob=None)
    delete_path(spark, path)
    assert sorted(r["id"] for r in df.collect()) == [1, 2]
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "__record" in plan and "Python" not in plan


def test_long_lines(spark):
    text = "é" * 3_000_000
    df = read(spark, [json.dumps({"t": text}, ensure_ascii=False), '{"t": "b"}'])
    assert sorted(len(r["t"]) for r in df.collect()) == [1, 3_000_000]


def test_types():
    found = variant_type("OBJECT<a: BIGINT, `x OBJECT<`: ARRAY<OBJECT<b: VARIANT>>, c: VOID>")
    assert found["x OBJECT<"].dataType.elementType["b"].dataType == T.VariantType()
    assert widened(found).simpleString() == "struct<a:bigint,x OBJECT<:array<struct<b:string>>,c:string>"
