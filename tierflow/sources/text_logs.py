"""Text logs: dictionary-literal lines and tab-separated key/value lines."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas


def read_text_lines(spark: SparkSession, paths: str | Sequence[str], line_sep: str = "\n") -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep=line_sep)


# ---------------------------------------------------------------------------------------------------------------------
# Dictionary literals
#
# A "plain" line is a flat literal whose strings hold no backslash or control character and whose other values are
# integers, None, True or False. Such a line differs from JSON only in its quotes and in three bare words, so the JVM
# parses it. Any other line (escapes, nested values, floats, tuples) goes through a literal parser in an Arrow batch.

_STRING = r"""(?:'[^'\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+")"""
_VALUE = rf"(?:{_STRING}|-?(?:0|[1-9][0-9]*+)|None|True|False)"
_PAIR = rf"{_STRING}\s*+:\s*+{_VALUE}"
PLAIN_LITERAL = rf"^\s*+\{{\s*+(?:{_PAIR}\s*+(?:,\s*+{_PAIR}\s*+)*+,?\s*+)?\}}\s*+$"

# Literal words and their JSON spelling.
BARE_WORDS = {"None": "null", "True": "true", "False": "false"}


def _outside_strings(word: str) -> str:
    """Pattern for ``word`` outside quotes: matches are chained, and each one first steps over whole strings."""
    return rf"""\G((?:'[^']*+'|"[^"]*+"|[^'"{word[0]}])*+){word}"""


def plain_literal_to_json(line: Column) -> Column:
    """JSON text of a plain line: bare words respelled, a trailing comma dropped."""
    text = line
    for word, spelling in BARE_WORDS.items():
        text = F.regexp_replace(text, _outside_strings(word), f"$1{spelling}")
    return F.regexp_replace(text, r",\s*\}\s*$", "}")


@F.pandas_udf(T.StringType())
def _literal_to_json(lines: pd.Series) -> pd.Series:
    def convert(line: str | None) -> str | None:
        if line is None:
            return None
        try:
            return json.dumps(ast.literal_eval(line))
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    if lines.isna().all():
        return pd.Series([None] * len(lines), dtype="object")
    return lines.map(convert)


def parse_literal_lines(
    df: DataFrame,
    schema: T.StructType = schemas.PLAYER_LOG,
    line: str = "value",
    fallback: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """The literal's entries as the columns of ``schema``.

    A line that is no dictionary literal gives a row of nulls; with ``corrupt`` its text is kept in a column of that name.
    Without ``fallback`` no Python worker runs and every line that is not plain counts as unreadable.
    """
    text = F.col(line)
    plain = F.coalesce(text.rlike(PLAIN_LITERAL), F.lit(False))
    native = F.when(plain, plain_literal_to_json(text))
    if fallback:
        prepared = df.select("*", native.alias("__native"), F.when(~plain, text).alias("__rest"))
        as_json = F.coalesce("__native", _literal_to_json("__rest"))
    else:
        prepared, as_json = df, native
    # The JSON reader takes single quotes; a line may also be a literal of another kind, which is no record.
    record = F.when(as_json.rlike(r"^\s*\{"), as_json)
    parsed = prepared.select(F.from_json(record, schema).alias("data"), text.alias("__line"), record.alias("__json"))
    columns = [F.col(f"data.{name}").alias(name) for name in schema.fieldNames()]
    if corrupt is not None:
        columns.append(F.when(F.col("__json").isNull(), F.col("__line")).alias(corrupt))
    return parsed.select(*columns)


# Fixed value: the time format of the log.
SESSION_TIME_PATTERN = "yyyy:MM:dd:HH:mm:ss:SSS"


def session_timestamp(column: Column | str) -> Column:
    """Timestamp from ``<mac>:yyyy:MM:dd:HH:mm:ss:SSS``; null for other text."""
    text = F.col(column) if isinstance(column, str) else column
    after_mac = F.substr(text, F.instr(text, F.lit(":")) + 1)
    return F.try_to_timestamp(after_mac, F.lit(SESSION_TIME_PATTERN))


def read_player_log(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = schemas.PLAYER_LOG, fallback: bool = True
) -> DataFrame:
    """Player log lines with a parsed session time; ``fallback`` as in ``parse_literal_lines``."""
    parsed = parse_literal_lines(read_text_lines(spark, paths), schema, fallback=fallback)
    return parsed.withColumn("SessionMainMenu", session_timestamp("SessionMainMenu"))


# ---------------------------------------------------------------------------------------------------------------------
# Tab-separated pairs


def parse_keyed_tsv(
    df: DataFrame, key: str = "MacId", value: str = "Days", prefix: int = 4, line: str = "value", dtype: str = "int"
) -> DataFrame:
    """Key without its ``prefix`` characters, and a typed value; lines without a readable value (headers) drop."""
    parts = F.split(F.col(line), "\t")
    return df.select(
        F.regexp_replace(F.get(parts, F.lit(0)), f"^.{{{prefix}}}", "").alias(key),
        F.get(parts, F.lit(1)).try_cast(dtype).alias(value),
    ).filter(F.col(value).isNotNull())


def read_keyed_tsv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    return parse_keyed_tsv(read_text_lines(spark, paths), **options)
