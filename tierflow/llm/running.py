"""Running totals over range partitions, so that one group may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

PART = "__part"


def range_parts(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows range-partitioned by ``order`` and stored with the number of their partition; ``parts`` fixes how many there are.

    Stored, because partition numbers are only meaningful as long as nobody computes them anew.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), "ranges")


def running_total(df: DataFrame, group: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with the inclusive running sum of ``value`` per ``group`` (not null) in ``order`` as ``out``.

    A group is spread over as many partitions as it fills: the sum inside a partition starts from the total of the
    group's earlier partitions.
    """
    parts = range_parts(df, [group, *order])
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(group, PART).agg(F.sum(value).alias("__sum"))
    totals = totals.select(group, PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn("__inside", F.sum(value).over(inside)).join(totals, [group, PART])
    return summed.withColumn(out, F.col("__before") + F.col("__inside")).drop("__before", "__inside", PART)


_FOLDS = {"sum": (F.sum, lambda a, b: a + b), "bit_xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def running_folds(df: DataFrame, group: str, order: Sequence[str], folds: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with several inclusive running folds per ``group`` (not null) in ``order``: ``{out: (fold, column)}``, fold ``sum`` or ``bit_xor``.

    As in ``running_total`` a group may be spread over many partitions; null values count as 0.
    """
    parts = range_parts(df, [group, *order])
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def zero(column):
        return F.coalesce(column, F.lit(0))

    totals = parts.groupBy(group, PART).agg(*[_FOLDS[fold][0](value).alias(f"__all_{out}") for out, (fold, value) in folds.items()])
    totals = totals.select(group, PART, *[zero(_FOLDS[fold][0](f"__all_{out}").over(before)).alias(f"__before_{out}") for out, (fold, _) in folds.items()])
    joined = parts.withColumns({f"__inside_{out}": zero(_FOLDS[fold][0](value).over(inside)) for out, (fold, value) in folds.items()}).join(totals, [group, PART])
    joined = joined.withColumns({out: _FOLDS[fold][1](F.col(f"__before_{out}"), F.col(f"__inside_{out}")) for out, (fold, _) in folds.items()})
    return joined.drop(PART, *[f"__{kind}_{out}" for kind in ("before", "inside") for out in folds])
