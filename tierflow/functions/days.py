"""Exact distinct-day counts without a distinct aggregation.

A group's days are a small set that combines map-side and needs one exchange on the group key, where ``count_distinct`` needs
two. In short periods a day is one bit of a few 63-bit words in fixed buffers; in longer ones the set lists the days that the
group has, so its size follows the group's rows and not the period. Sets merge, so the days of all groups follow from the
groups' own sets. A date outside the stated period is an error in both forms.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BITS, WORDS = 63, 8


def _offset(date: Column, first: dt.date, last: dt.date) -> Column:
    """Days since the first one; null dates stay null."""
    offset = F.datediff(date, F.lit(first))
    outside = F.raise_error(F.concat(F.lit(f"date outside {first}..{last}: "), date.cast("string"))).cast("int")
    return F.when(offset.between(0, (last - first).days) | offset.isNull(), offset).otherwise(outside)


def day_sets(date: Column, first: dt.date, last: dt.date) -> list[Column]:
    """Aggregates whose results together hold the days of a group within ``first..last``: longs, or one list."""
    offset, days = _offset(date, first, last), (last - first).days + 1
    if lists_days(first, last):
        return [F.collect_set(offset)]
    sets = []
    for index in range((days - 1) // WORD_BITS + 1):
        bit = offset - index * WORD_BITS
        in_word = F.when(bit.between(0, WORD_BITS - 1), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
        sets.append(F.coalesce(F.bit_or(in_word), F.lit(0).cast("bigint")))
    return sets


def is_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType)


def lists_days(first: dt.date, last: dt.date) -> bool:
    return (last - first).days + 1 > WORD_BITS * WORDS


def days_in_all(df: DataFrame, sets: Sequence[str], listed: bool) -> DataFrame:
    """One row ``n``: number of days that any of the frame's sets holds."""
    if listed:
        return df.select(F.explode(sets[0]).alias("day")).agg(F.count_distinct("day").alias("n"))
    merged = df.agg(*[F.bit_or(name).alias(name) for name in sets])
    return merged.select(days_in_sets([F.col(name) for name in sets], listed).alias("n"))


def days_in_sets(sets: Sequence[Column], listed: bool) -> Column:
    """Number of days in the sets."""
    count = F.size if listed else F.bit_count
    return reduce(lambda left, right: left + right, [count(days).cast("bigint") for days in sets])
