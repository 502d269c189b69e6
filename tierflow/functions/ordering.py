"""Position of values among sorted cut points: ranks and z-order curves."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import local_frame

# Cut points only steer a curve, so they come from a sample whose size does not depend on the table: at most
# ``SAMPLE_ROWS_PER_CUT << MAX_BITS`` rows.
SAMPLE_ROWS_PER_CUT = 64
MAX_BITS = 10


def _sample(df: DataFrame, parts: int, rows: int) -> DataFrame:
    """About ``SAMPLE_ROWS_PER_CUT`` rows per part, of a frame of ``rows`` rows."""
    wanted = parts * SAMPLE_ROWS_PER_CUT
    return df if rows <= wanted else df.sample(fraction=wanted / rows, seed=7)


def _constant(df: DataFrame, values: Sequence[Any], element: T.DataType) -> Column:
    """An array of driver-side values, as a scalar subquery over a local relation."""
    schema = T.StructType([T.StructField("values", T.ArrayType(element))])
    return local_frame(df.sparkSession, [(list(values),)], schema).scalar()


def with_rank_in(df: DataFrame, value: str, table: str, longest: int, alias: str) -> DataFrame:
    """``df`` plus the number of entries of the ascending array column ``table`` that are at most ``value``.

    A binary search over at most ``longest`` entries. Each step is one small projection, which generated code evaluates in
    place, and an entry beyond the array's end reads as null, which no value passes. A null value has rank 0.
    """
    ranked = df.withColumn(alias, F.lit(0))
    for bit in reversed(range(longest.bit_length())):
        step = 1 << bit
        passed = F.col(value) >= F.get(table, F.col(alias) + F.lit(step - 1))
        ranked = ranked.withColumn(alias, F.when(passed, F.col(alias) + F.lit(step)).otherwise(F.col(alias)))
    return ranked


def with_rank(df: DataFrame, value: str, cuts: Sequence[Any], alias: str) -> DataFrame:
    """``df`` plus the number of driver-side ``cuts``, ascending, that are at most ``value``."""
    table = f"{alias}_cuts"
    ranked = df.withColumn(table, _constant(df, cuts, df.schema[value].dataType))
    return with_rank_in(ranked, value, table, len(cuts), alias).drop(table)


def quantile_cuts(df: DataFrame, columns: Sequence[str], parts: int, rows: int) -> dict[str, list[Any]]:
    """Approximate ``parts``-quantile cut points of each column, without repeats."""
    collected = _sample(df.select(*columns), parts, rows).collect() if rows else []
    cuts: dict[str, list[Any]] = {}
    for column in columns:
        values = sorted(row[column] for row in collected if row[column] is not None)
        picked = [values[len(values) * index // parts] for index in range(1, parts)] if values else []
        cuts[column] = list(dict.fromkeys(picked))
    return cuts


def spread_bits(value: int, step: int, offset: int) -> int:
    """Place bit ``b`` of ``value`` at position ``b * step + offset``."""
    spread, bit = 0, 0
    while value >> bit:
        spread |= ((value >> bit) & 1) << (bit * step + offset)
        bit += 1
    return spread


def curve_bits(columns: int, partitions: int) -> int:
    """Bits per column so that the curve has several cells per partition, as far as ``MAX_BITS`` allow it."""
    cells = (16 * partitions).bit_length()
    return max(4, min(MAX_BITS, 62 // columns, -(-cells // columns)))


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int, rows: int, alias: str) -> DataFrame:
    """``df`` plus the bit-interleaved rank of several columns, ``bits`` per column.

    A rank is looked up in a table of its bits already spread to the column's own positions, so interleaving costs one
    addition per column.
    """
    if bits > MAX_BITS or bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits: at most {MAX_BITS} bits each and 62 in all")
    ranked, names = df, []
    for offset, (column, values) in enumerate(quantile_cuts(df, columns, 1 << bits, rows).items()):
        names += [f"{alias}_rank{offset}", f"{alias}_bits{offset}"]
        ranked = with_rank(ranked, column, values, names[-2])
        spread = [spread_bits(rank, len(columns), offset) for rank in range(1 << bits)]
        ranked = ranked.withColumn(names[-1], F.get(_constant(df, spread, T.LongType()), F.col(names[-2])))
    total = F.col(names[1])
    for name in names[3::2]:
        total = total + F.col(name)
    return ranked.withColumn(alias, F.coalesce(total, F.lit(0).cast("bigint"))).drop(*names)
