import ast
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow.plans.player_log import player_sessions
from tierflow.sources import parse_keyed_tsv, parse_literal_lines, read_keyed_tsv, read_player_log, session_timestamp

FIELDS = ["Mac", "SessionMainMenu", "LogId", "Event", "ItemId", "RealTimePlaying"]

LINES = [
    "{'Mac': 'B0', 'Event': 'x'}",
    "{'Mac': 'B1', 'Event': None}",
    "{'Mac': 'B2', 'Event': True, 'LogId': False}",
    """{'Mac': "it's", 'Event': 'say "hi"'}""",
    "{'Mac': ': None,', 'Event': ': True, None', 'LogId': None}",
    "{'Mac': 'None', 'Event': 'True', 'ItemId': None,}",
    r"{'Mac': 'a\'b', 'Event': 'tab\there', 'LogId': '\x41é'}",
    "{'Mac': 'B6', 'LogId': 12, 'ItemId': -3, 'RealTimePlaying': 1.50}",
    "{'Mac': 'B7', 'Event': {'a': 1, 'b': [1, 2]}, 'LogId': (1, 2)}",
    "{'Mac': 'B8', 'Mac': 'B9', 'Event': 'dup'}",
    "{'Mac': 'é', 'Event': 'Việt Nam'}",
    "  { 'Mac' : 'sp' , 'Event':'y' }  ",
    "{}",
    "{'Mac': 1e5, 'LogId': 0x10, 'ItemId': 1_000}",
    """{"Mac": "dq", "Event": "a 'b' c"}""",
    "{'Mac': 'a\tb'}",
]
BAD = ["not a literal", "{'Mac': unquoted}", "{'Mac': {1, 2}}", "[1, 2]", "", "{'Mac': 'x'", "{'Mac': 007}"]


def expected(line):
    """What a JSON reader with string fields gives for the dumped literal."""
    record = json.loads(json.dumps(ast.literal_eval(line.strip())), parse_float=str, parse_int=str)

    def text(value):
        if value is None or isinstance(value, str):
            return value
        if isinstance(value, bool):
            return str(value).lower()
        raw = json.loads(json.dumps(value), parse_int=int)
        return json.dumps(raw, separators=(",", ":"))

    out = {}
    for name in FIELDS:
        value = record.get(name)
        if isinstance(value, (dict, list)):
            value = json.dumps(ast.literal_eval(line.strip())[name], separators=(",", ":"))
        out[name] = text(value)
    return tuple(out[name] for name in FIELDS)


@pytest.mark.parametrize("line", LINES)
def test_literal_line_equals_literal_parser(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    assert [tuple(r) for r in parse_literal_lines(df).collect()] == [expected(line)]


def test_unreadable_lines_are_kept_as_text(spark):
    df = spark.createDataFrame([(line,) for line in BAD], "value string")
    out = parse_literal_lines(df, corrupt="bad").collect()
    assert sorted(r["bad"] for r in out) == sorted(BAD)
    assert all(r[name] is None for r in out for name in FIELDS)


def test_plain_lines_need_no_python_worker(spark):
    df = spark.createDataFrame([(line,) for line in LINES[:6]], "value string")
    native = parse_literal_lines(df, fallback=False)
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    assert rows(native) == rows(parse_literal_lines(df))


def test_player_log_file(spark, tmp_path):
    path = tmp_path / "log.txt"
    path.write_text("{'Mac': 'B046FCB79E0B', 'SessionMainMenu': 'B046FCB79E0B:2016:02:12:00:35:13:437', 'LogId': '40'}\n")
    out = read_player_log(spark, str(path)).withColumn("SessionMainMenu", F.col("SessionMainMenu").cast("string"))
    assert [tuple(r) for r in out.collect()] == [("B046FCB79E0B", "2016-02-12 00:35:13.437", "40", None, None, None)]


def test_session_timestamp_of_other_text_is_null(spark):
    df = spark.createDataFrame([("nonsense",), (None,), ("B0:2016:13:40:00:00:00:000",)], "s string")
    assert [r[0] for r in df.select(session_timestamp("s")).collect()] == [None, None, None]


def test_keyed_tsv(spark, tmp_path):
    path = tmp_path / "user.txt"
    path.write_text("MAC\t#days\nAAAAB046FCB7\t12\nAAAAC0FFEE00\nAAAAD0\tx\nAAAAE0\t\nAB\t7\n")
    assert rows(read_keyed_tsv(spark, str(path))) == [("AB", 7), ("B046FCB7", 12)]


def test_keyed_tsv_types(spark):
    df = parse_keyed_tsv(spark.createDataFrame([("AAAAx\t1",)], "value string"))
    assert dict(df.dtypes) == {"MacId": "string", "Days": "int"}


def test_player_sessions_keep_every_log_row(spark, tmp_path):
    (tmp_path / "log.txt").write_text("{'Mac': 'B0', 'Event': 'x'}\n{'Mac': 'B1'}\n{'Mac': None}\n{'Mac': 'B2'}\n")
    (tmp_path / "info.txt").write_text("MAC\t#days\n0000B0\t7\n0000B1\tnone\n0000B2\t1\n0000B2\t2\n")
    out = player_sessions(spark, str(tmp_path / "log.txt"), str(tmp_path / "info.txt"))
    assert out.columns == [*FIELDS, "Days"]
    found = sorted((r["Mac"] or "", r["Days"] or 0) for r in out.collect())
    assert found == [("", 0), ("B0", 7), ("B1", 0), ("B2", 1), ("B2", 2)]
