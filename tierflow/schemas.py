"""Schemas of raw inputs and published layers."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Names and types of the input and output columns.

# Raw search-index hit: metadata fields around a nested source document.
RAW_HIT = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("_index", T.StringType()),
        T.StructField("_score", T.LongType()),
        T.StructField(
            "_source",
            T.StructType(
                [
                    T.StructField("AppName", T.StringType()),
                    T.StructField("Contract", T.StringType()),
                    T.StructField("Mac", T.StringType()),
                    T.StructField("TotalDuration", T.LongType()),
                ]
            ),
        ),
        T.StructField("_type", T.StringType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("Index", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Id", T.StringType()),
        T.StructField("Score", T.LongType()),
        T.StructField("AppName", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("Mac", T.StringType()),
        T.StructField("TotalDuration", T.LongType()),
        T.StructField("Date", T.DateType()),
    ]
)

DURATION_COLUMNS = ("TVDuration", "ChildDuration", "MovieDuration", "RelaxDuration", "SportDuration")
MOST_WATCHED_COLUMNS = ("MostWatch", "SecondMostWatch", "ThirdMostWatch")
SCORE_COLUMNS = ("RecencyScore", "FrequencyScore", "MonetaryDurationScore")

SILVER = T.StructType(
    [T.StructField("Contract", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in DURATION_COLUMNS]
    + [T.StructField(name, T.StringType()) for name in MOST_WATCHED_COLUMNS]
)

RFM = T.StructType(
    [
        T.StructField("Contract", T.StringType()),
        T.StructField("Recency", T.IntegerType()),
        T.StructField("Frequency", T.DoubleType()),
        T.StructField("MonetaryDuration", T.LongType()),
    ]
    + [T.StructField(name, T.IntegerType()) for name in SCORE_COLUMNS]
)

GOLD = T.StructType(SILVER.fields + [T.StructField(name, T.IntegerType()) for name in SCORE_COLUMNS])

# One set-top-box log line, written as a dictionary literal.
PLAYER_LOG = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("Mac", "SessionMainMenu", "LogId", "Event", "ItemId", "RealTimePlaying")
    ]
)

USER_INFO = T.StructType([T.StructField("MacId", T.StringType()), T.StructField("Days", T.IntegerType())])

LAYERS = {"bronze": BRONZE, "silver": SILVER, "rfm": RFM, "gold": GOLD}


def ddl_columns(schema: T.StructType) -> list[tuple[str, str]]:
    """``(name, type)`` pairs as ``create_table`` takes them."""
    return [(field.name, field.dataType.simpleString().upper()) for field in schema.fields]
