"""Ranking of a row's own columns, and exact distributed ntile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.runtime import materialize

# ---------------------------------------------------------------------------------------------------------------------
# Per-row rankings


def top_categories(measures: Mapping[str, str], names: Sequence[str]) -> list[Column]:
    """The largest columns of each row, by label, one output per name.

    ``measures`` maps a column to its label. Nulls rank last and equal values rank by label, largest first. The first
    output always has a label; the others are null where the ranked value is null.
    """
    by_label = sorted(measures.items(), key=lambda item: item[1], reverse=True)

    def place(position: int) -> Column:
        """How many columns rank before this one."""
        column = F.col(by_label[position][0])
        ahead = []
        for number, (other, _) in enumerate(by_label):
            if number != position:
                wins = F.col(other) >= column if number < position else F.col(other) > column
                unset = F.col(other).isNotNull() | F.lit(number < position)
                ahead.append(F.when(column.isNull(), unset).otherwise(F.coalesce(wins, F.lit(False))).cast("int"))
        return reduce(lambda x, y: x + y, ahead, F.lit(0))

    # every output looks into the same two arrays, which a projection computes once for a row
    places = F.array(*[place(position) for position in range(len(by_label))])
    values = F.array(*[F.col(column).isNotNull() for column, _ in by_label])
    labels = F.array(*[F.lit(label) for _, label in by_label])
    outputs = []
    for position, name in enumerate(names):
        at = F.array_position(places, F.lit(position)).cast("int") - 1
        label = F.get(labels, at)
        outputs.append((F.when(F.get(values, at), label) if position else label).alias(name))
    return outputs


def argmax_column(measures: Mapping[str, str], fill: int | float = 0, default: str = "Error") -> Column:
    """Label of the first column holding the row's greatest value; null counts as ``fill``."""
    filled = {column: F.coalesce(F.col(column), F.lit(fill)) for column in measures}
    largest = F.greatest(*filled.values()) if len(filled) > 1 else next(iter(filled.values()))
    label = F.lit(default)
    for column, name in reversed(list(measures.items())):
        label = F.when(filled[column] == largest, F.lit(name)).otherwise(label)
    return label


# ---------------------------------------------------------------------------------------------------------------------
# Exact ntile

_PART = "__part"


def ntiles_exact(
    df: DataFrame, buckets: int, values: Mapping[str, str], key: str | Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """``ntile(buckets)`` of several columns, given as ``{output: column}``; nulls first, ties by ``key``.

    Same bucket sizes as the window function at every size, over all rows or per ``partition_by`` group. Rows with equal
    value and key are interchangeable: the buckets take the right number of them, in no stated order.

    The values of all columns are stacked into narrow rows, range-partitioned once by (column, group, value, key) and
    stored with their partition's number. A rank is the number inside the group's part of a partition plus the group's
    rows in earlier partitions, so a group is spread over as many tasks as it fills.
    """
    keys = [key] if isinstance(key, str) else list(key)
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    columns = list(values.values())

    def entry(number: int) -> Column:
        fields = [F.col(c) if i == number else F.lit(None).cast(df.schema[c].dataType) for i, c in enumerate(columns)]
        return F.struct(F.lit(number).alias("__metric"), *[field.alias(f"__v{i}") for i, field in enumerate(fields)])

    groups = [f"__g{i}" for i in range(len(partition_by))]
    names = [*[F.col(c).alias(g) for c, g in zip(partition_by, groups)], *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)]]
    stacked = numbered.select("__row", *names, F.inline(F.array(*[entry(i) for i in range(len(columns))])))
    own = ["__metric", *groups]
    order = [F.col(c).asc_nulls_first() for c in [*[f"__v{i}" for i in range(len(columns))], *[f"__k{i}" for i in range(len(keys))]]]
    ranged = stacked.repartitionByRange(*[F.col(c).asc_nulls_first() for c in own], *order)
    stored = materialize(ranged.withColumn(_PART, F.spark_partition_id()), "ranked")

    whole = Window.partitionBy(*own)
    before = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(*own, _PART).agg(F.count("*").alias("__n"))
    offsets = counts.select(
        *[F.col(c).alias(f"{c}_") for c in [*own, _PART]], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__rows")
    )
    inside = F.row_number().over(Window.partitionBy(*own, _PART).orderBy(*order))
    same = [stored[c].eqNullSafe(offsets[f"{c}_"]) for c in [*own, _PART]]
    ranked = stored.withColumn("__inside", inside).join(offsets, reduce(lambda x, y: x & y, same))
    rank, size = F.col("__before") + F.col("__inside") - 1, F.expr(f"__rows div {int(buckets)}")
    larger = F.col("__rows") % buckets
    in_larger = larger * (size + 1)
    late = larger + F.try_divide(rank - in_larger, size).cast("long")
    bucket = F.when(rank < in_larger, (rank / (size + 1)).cast("long")).otherwise(late) + 1
    found = ranked.select("__row", "__metric", bucket.cast("int").alias("__bucket"))
    wide = found.groupBy("__row").agg(*[F.max(F.when(F.col("__metric") == i, F.col("__bucket"))).alias(f"__b{i}") for i in range(len(columns))])
    joined = numbered.join(wide, "__row")
    return joined.select(*df.columns, *[F.col(f"__b{i}").alias(alias) for i, alias in enumerate(values)])


def ntile_exact(
    df: DataFrame, buckets: int, value: str, key: str | Sequence[str], alias: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """``ntiles_exact`` of one column."""
    return ntiles_exact(df, buckets, {alias: value}, key, partition_by)
