"""Category pivots: one row per key, one column per category."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sums(label: Column | str, measure: Column | str, categories: Sequence[str]) -> list[Column]:
    """One conditional sum per category; a category without rows gives null."""
    label = F.col(label) if isinstance(label, str) else label
    measure = F.col(measure) if isinstance(measure, str) else measure
    return [F.sum(F.when(label == category, measure)).alias(category) for category in categories]


def category_pivot(
    df: DataFrame, keys: Sequence[str] | str, label: str, measure: str, categories: Sequence[str]
) -> DataFrame:
    """Sum of ``measure`` per key and category, null where a key has no row of a category.

    The categories are given, so no job has to discover them and the columns do not depend on the data. Conditional
    sums combine map-side and need one exchange on the key; grouping by key and category first would need two.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*pivot_sums(label, measure, categories))


def grouped_pivot(
    df: DataFrame, keys: Sequence[str] | str, category: str, measure: str, targets: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Pivot on the raw category, several source values feeding one target column; absent targets are null."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = [
        F.sum(F.when(F.col(category).isin(list(sources)), F.col(measure))).alias(target)
        for target, sources in targets.items()
    ]
    return df.groupBy(*keys).agg(*sums)


def conditional_pivot(
    df: DataFrame,
    keys: Sequence[str] | str,
    category: str,
    measure: str,
    targets: Mapping[str, Sequence[str]],
    fill: int | float = 0,
) -> DataFrame:
    """Zero-filled pivot: every key of ``df`` keeps a row, and rows of other categories add ``fill``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = [
        F.sum(F.when(F.col(category).isin(list(sources)), F.col(measure)).otherwise(F.lit(fill))).alias(target)
        for target, sources in targets.items()
    ]
    return df.groupBy(*keys).agg(*sums)


def ordered_by(df: DataFrame, measure: str, *tie_breakers: str) -> DataFrame:
    """Total order, largest ``measure`` first; nulls last; ties by the given columns."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(name).asc() for name in tie_breakers])
