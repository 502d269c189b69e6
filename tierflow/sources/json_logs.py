"""Nested JSON logs: one document per line, the event date in the file name."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas

FILE_NAME_DATE = r"\d{8}"
PATH_COLUMN = "__path"


def date_from_path(path: Column | str, pattern: str = FILE_NAME_DATE, fmt: str = "yyyyMMdd") -> Column:
    """Date from the first match of ``pattern`` in the text; null without a match or for an impossible date.

    If the pattern has a group, the group holds the date.
    """
    column = F.col(path) if isinstance(path, str) else path
    group = 1 if re.compile(pattern).groups else 0
    return F.try_to_date(F.regexp_extract(column, pattern, group), fmt)


def read_json_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = schemas.RAW_HIT,
    glob: str | None = "*.json",
    keep_corrupt: bool = True,
    recursive: bool = False,
    ignore_missing: bool = False,
) -> DataFrame:
    """JSON lines with the path of their file in ``__path``.

    With a schema (the default) there is no inference pass, and lines that do not parse keep their text in
    ``_corrupt_record`` if ``keep_corrupt``. ``schema=None`` infers it, for exploration.
    """
    reader = spark.read
    if schema is not None:
        if keep_corrupt and schemas.CORRUPT_COLUMN not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT_COLUMN, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN)
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    df = reader.json(paths if isinstance(paths, str) else list(paths))
    return df.select("*", F.col("_metadata.file_path").alias(PATH_COLUMN))


def flatten_hits(
    df: DataFrame, date_pattern: str = FILE_NAME_DATE, whole_path: bool = False
) -> DataFrame:
    """Wide rows: renamed metadata, the fields of ``_source``, and the date taken from the file.

    The date is looked up in the file's own name, or with ``whole_path`` in its full path. Null ``_source`` gives nulls.
    A ``_corrupt_record`` column is passed through.
    """
    located = F.col(PATH_COLUMN) if whole_path else F.element_at(F.split(PATH_COLUMN, "/"), -1)
    columns = [
        F.col("_index").alias("Index"),
        F.col("_type").alias("Type"),
        F.col("_id").alias("Id"),
        F.col("_score").alias("Score"),
        F.col("_source.*"),
        date_from_path(located, date_pattern).alias("Date"),
    ]
    if schemas.CORRUPT_COLUMN in df.columns:
        columns.append(F.col(schemas.CORRUPT_COLUMN))
    return df.select(*columns)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows without the corrupt column, and the rows that did not parse.

    Pass a materialised frame, so that the raw files are parsed once.
    """
    corrupt = F.col(schemas.CORRUPT_COLUMN)
    good = df.filter(corrupt.isNull()).drop(schemas.CORRUPT_COLUMN)
    bad = df.filter(corrupt.isNotNull()).select("Date", schemas.CORRUPT_COLUMN)
    return good, bad
