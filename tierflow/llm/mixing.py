"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document waits in the queue of its source, in an order shuffled by a hash of its key. Its virtual finish time is
the source's cumulative size up to and including it, divided by the source's target. One global range sort by finish
time interleaves the sources in proportion to their targets, and the mix is the part of that order that fits the budget.
A source whose target exceeds its size queues up again, as often as ``max_epochs``.

Defined cases: a null text has size 0; documents of size 0 take no part (taken 0); null is a source like any other, last
in order; repeated rows count one by one; an empty table gives an empty one; with no words at all every target is 0.
Columns beyond key and source are not looked at, whatever their names; ``mixture`` hands them on as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .running import PART, range_parts, running_total

ONE_TASK_ROWS = 10_000  # rows that one task may put in order to find the cut
MOST_PARTS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``(source, source_size, source_no, target)`` from a row per document with its source and ``size``.

    Weights go to the sources in code point order, null last, and repeat. Targets share the total of all sizes; none
    exceeds ``max_epochs`` times its source's size, and the excess goes to the others by weight. Sorted by how soon they
    reach their limit, the sources before the first one with room are at their limits, and that one sets the level. The
    windows run over one row per source.
    """
    table = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    number = (F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1).cast("long")
    table = table.withColumn("source_no", number)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = table.withColumn("weight", F.element_at(cycle, (F.col("source_no") % len(weights) + 1).cast("int")).cast("long"))
    limit = F.col("source_size") * F.lit(max_epochs)
    table = table.withColumns({"limit": limit, "fill": limit.cast("double") / F.col("weight")})
    by_fill = Window.orderBy("fill", "source_no")
    spent = F.coalesce(F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    table = table.withColumn("level", (total - spent).cast("double") / rest)
    roomy = F.when(F.col("level") < F.col("fill"), F.col("level"))
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = table.withColumn("level", F.first(roomy, ignorenulls=True).over(everything))
    target = F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
    return table.select(source, "source_size", "source_no", target.alias("target"))


def _first_out(ranged: DataFrame, place: Sequence[str], budget: int) -> Row | None:
    """The first row, in the order of ``place``, that the budget has no room for; ``None`` if there is room for all.

    The partition in which the budget runs out is range-partitioned again until it is small enough for one task.
    """
    room = budget
    while True:
        before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        totals = ranged.groupBy(PART).agg(F.sum("__size").alias("__sum"), F.count("*").alias("__rows"))
        totals = totals.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        crossing = totals.where(F.col("__before") + F.col("__sum") > room).orderBy(PART).first()
        if crossing is None:
            return None
        room -= crossing["__before"]
        ranged = ranged.where(F.col(PART) == crossing[PART])
        if crossing["__rows"] <= ONE_TASK_ROWS:
            inside = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
            return ranged.withColumn("__inside", F.sum("__size").over(inside)).where(F.col("__inside") > room).orderBy(*place).first()
        ranged = range_parts(ranged.drop(PART), place, min(MOST_PARTS, 1 + crossing["__rows"] // ONE_TASK_ROWS))


def _queued(df: DataFrame, size: Column, key: str, source: str, weights: Sequence[int], max_epochs: int, seed: str, keep: Column) -> DataFrame:
    """``(__row, __key, __source, __size, __source_size, __target, __taken)`` per row of ``df``; ``__row`` is ``keep``."""
    rows = df.select(
        keep.alias("__row"), F.col(key).alias("__key"), F.col(source).alias("__source"), size.alias("__size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("__order"),
        F.monotonically_increasing_id().alias("__number"),
    )
    rows = materialize(rows, "sized")
    sources = targets(rows.select("__source", F.col("__size").alias("size")), "__source", weights, max_epochs)
    sources = materialize(sources.toDF("__name", "__source_size", "__source_no", "__target"), "targets")
    rows = rows.join(sources, F.col("__source").eqNullSafe(F.col("__name"))).drop("__name")
    queued = materialize(running_total(rows, "__source_no", ["__order", "__number"], "__size", "__done"), "queued")

    def finish(epoch: Column) -> Column:
        return F.try_divide((F.col("__done") + epoch * F.col("__source_size")).cast("double"), F.col("__target"))

    waiting = queued.where("__size > 0").withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    place = ["__finish", "__source_no", "__order", "__number", "__epoch"]
    ranged = range_parts(waiting.withColumn("__finish", finish(F.col("__epoch"))).select(*place, "__size"), place)
    first_out = _first_out(ranged, place, sources.agg(F.sum("__source_size")).first()[0] or 0)
    if first_out is not None:
        limit = F.struct(*[F.lit(first_out[name]).cast(ranged.schema[name].dataType).alias(name) for name in place])
    taken = F.lit(0).cast("long")
    for epoch in range(max_epochs):
        at = F.struct(
            finish(F.lit(epoch)).alias("__finish"), F.col("__source_no"), F.col("__order"), F.col("__number"), F.lit(epoch).alias("__epoch")
        )
        fits = F.col("__size") > 0 if first_out is None else (F.col("__size") > 0) & (at < limit)
        taken = taken + F.when(fits, F.col("__size")).otherwise(F.lit(0))
    return queued.select("__row", "__key", "__source", "__size", "__source_size", "__target", taken.alias("__taken"))


def mix(
    df: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``df``: key, source, ``size``, ``source_size``, ``target`` and ``taken`` (units of size, repeats counted)."""
    queued = _queued(df, size, key, source, weights, max_epochs, seed, F.lit(None).cast("boolean"))
    outputs = [F.col(f"__{name}").alias(name) for name in ("size", "source_size", "target", "taken")]
    return queued.select(F.col("__key").alias(key), F.col("__source").alias(source), *outputs)


def mixture(
    df: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The documents of the mix, all their columns as they were: each as often as it was taken, untaken ones left out."""
    queued = _queued(df, size, key, source, weights, max_epochs, seed, F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    times = F.call_function("div", F.col("__taken"), F.col("__size")).cast("int")
    repeated = queued.where("__taken > 0").select("__row", F.explode(F.array_repeat(F.lit(0), times)).alias("__copy"))
    return repeated.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns])
