"""Attaching attributes of a lookup table."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HOT, TRACKED = 256, 4096  # hot keys that are salted; keys that the sketch follows


def left_lookup(
    df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Left join on differently named keys, keeping the left columns and the chosen lookup columns.

    No hint is set. Spark broadcasts the lookup when its measured size is below the session's threshold; a larger lookup
    is shuffled, and adaptive execution splits a hot left key over several tasks, which a left join allows.
    """
    chosen = list(columns) if columns is not None else [c for c in lookup.columns if c != right_key]
    narrow = lookup.select(right_key, *[c for c in chosen if c != right_key])
    joined = df.join(narrow, df[left_key] == narrow[right_key], "left")
    return joined.select(*[df[c] for c in df.columns], *[narrow[c] for c in chosen])


def hot_keys(df: DataFrame, key: str, task_rows: int | None = None) -> list[tuple[object, int]]:
    """``(key, copies)`` of the keys with more rows than a task should take, by default the rows of an even share.

    One scan of the key column fills a sketch of the most frequent keys, whose counts are off by no more than the rows
    divided by ``TRACKED``; at most ``MOST_HOT`` keys come to the driver. The null key counts like any other.
    """
    kind = df.schema[key].dataType.simpleString()
    top = F.call_function("approx_top_k", F.col(key), F.lit(MOST_HOT), F.lit(TRACKED)).cast(f"array<struct<item: {kind}, count: bigint>>")
    found = df.agg(top.alias("top"), F.count_if(F.col(key).isNull()).alias("nulls"), F.count("*").alias("rows")).first()
    most = task_rows or max(1, found["rows"] // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = [(entry["item"], entry["count"]) for entry in found["top"] or []] + [(None, found["nulls"])]
    return [(value, ceil(rows / most)) for value, rows in counts if rows > most]


def hot_key_lookup(
    df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, columns: Sequence[str] | None = None, task_rows: int | None = None
) -> DataFrame:
    """``left_lookup`` for keys that hold a large share of the left rows, whatever the session's settings.

    The hot keys are found first (``hot_keys``). Their left rows are dealt over as many salts as they fill tasks, by a hash of the whole row, and only their lookup rows are repeated, once for each salt. All other
    keys have salt 0 and join as they would without. ``df`` is read twice, once for its key column only.
    """
    hot = hot_keys(df, left_key, task_rows)
    if not hot:
        return left_lookup(df, lookup, left_key, right_key, columns)
    chosen = list(columns) if columns is not None else [c for c in lookup.columns if c != right_key]

    def copies(key: Column) -> Column:
        number = F.lit(1)
        for value, times in hot:
            number = F.when(key.isNull() if value is None else key == F.lit(value), F.lit(times)).otherwise(number)
        return number

    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), copies(F.col(left_key))).cast("int"))
    narrow = lookup.select(F.col(right_key).alias("__key"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(chosen)])
    repeated = narrow.withColumn("__copy", F.explode(F.sequence(F.lit(0), copies(F.col("__key")) - 1)))
    joined = salted.join(repeated, (salted[left_key] == repeated["__key"]) & (salted["__salt"] == repeated["__copy"]), "left")
    return joined.select(*[salted[c] for c in df.columns], *[F.col(f"__{i}").alias(c) for i, c in enumerate(chosen)])
