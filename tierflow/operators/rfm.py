"""Recency, frequency and monetary metrics per key, their scores and score codes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.days import day_sets, days_in_sets, lists_days
from tierflow.operators.ranking import ntiles_exact

METRICS = ("Recency", "Frequency", "MonetaryDuration")
SCORES = ("RecencyScore", "FrequencyScore", "MonetaryDurationScore")

Period = tuple[dt.date, dt.date]


def as_date(value: dt.date | str) -> dt.date:
    """A date, or text in ``yyyyMMdd`` or ISO form."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def period_days(df: DataFrame, date: str, alias: str = "period_days") -> DataFrame:
    """One row: number of distinct non-null dates. Lazy, and reads only the date column."""
    return df.agg(F.count_distinct(F.col(date)).alias(alias))


def date_bounds(df: DataFrame, date: str) -> Period | None:
    """First and last date, read by one job over the date column; ``None`` without any date."""
    row = df.agg(F.min(date).alias("first"), F.max(date).alias("last")).first()
    return None if row["first"] is None else (row["first"], row["last"])


def distinct_days(date: str, period: Period | None) -> Column:
    """Distinct dates per group; a known period counts the days of one mergeable set, and a date outside it is an error."""
    if period is None:
        return F.count_distinct(F.col(date))
    return days_in_sets(day_sets(F.col(date), *period), lists_days(*period))


def frequency(days: Column, total: Column | int) -> Column:
    """Share of the period's days, in percent, rounded to two digits; null for a period without days."""
    total = F.lit(total) if isinstance(total, int) else total
    return F.round(F.try_divide(days, total) * 100, 2)


def rfm_metrics(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    measure: str,
    report_date: dt.date | str,
    total_days: int | None = None,
    period: Period | None = None,
) -> DataFrame:
    """Recency, Frequency and MonetaryDuration per non-null key, in one aggregation.

    The latest date is a plain ``max`` in the same grouping. ``total_days`` fixes the length of the period; otherwise the
    distinct dates of all rows are counted by a scalar subquery of the same plan. ``period`` states the first and last
    date of the data, which lets day counting avoid a distinct aggregation.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total = F.lit(total_days) if total_days is not None else df.agg(distinct_days(date, period).alias("n")).scalar()
    keyed = df
    for name in keys:
        keyed = keyed.filter(F.col(name).isNotNull())
    grouped = keyed.groupBy(*keys).agg(
        F.max(date).alias("__latest"),
        distinct_days(date, period).alias("__days"),
        F.sum(measure).alias(METRICS[2]),
    )
    return grouped.select(
        *keys,
        F.datediff(F.lit(as_date(report_date)), F.col("__latest")).alias(METRICS[0]),
        frequency(F.col("__days"), total).alias(METRICS[1]),
        METRICS[2],
    )


def activeness(
    df: DataFrame, key: str, date: str, days: float = 30.0, alias: str = "Activeness", period: Period | None = None
) -> DataFrame:
    """Share of ``days`` on which a key has rows."""
    return df.groupBy(key).agg((distinct_days(date, period) / F.lit(float(days))).cast("float").alias(alias))


def score(
    metrics: DataFrame,
    key: str | Sequence[str],
    buckets: int = 4,
    partition_by: Sequence[str] = (),
    invert_recency: bool = False,
    columns: Sequence[str] = METRICS,
    names: Sequence[str] = SCORES,
) -> DataFrame:
    """Ntile of each metric, ascending, nulls first, ties by key; over all keys or per ``partition_by`` group.

    ``invert_recency`` ranks the largest recency first, so that a high score is good for all three metrics. ``metrics``
    is read several times, so pass a materialised frame.
    """
    values = dict(zip(names, columns))
    ranked = metrics
    if invert_recency:
        ranked = metrics.withColumn("__inverted", -F.col(columns[0]))
        values[names[0]] = "__inverted"
    return ntiles_exact(ranked, buckets, values, key, partition_by).drop("__inverted")


def rfm_code(scores: Sequence[str] = SCORES) -> Column:
    """The scores written one after the other; null if any is null."""
    return F.concat(*[F.col(name).cast("string") for name in scores])


def exclude_code(code: Column | str, pattern: str = "111") -> Column:
    """Predicate: the code does not match the ``LIKE`` pattern; a null code does not pass."""
    column = F.col(code) if isinstance(code, str) else code
    return ~column.like(pattern)
