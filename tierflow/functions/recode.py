"""Category recoding and row usability predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.runtime import local_frame

UNKNOWN = "Unknown"

MAPPING_SCHEMA = T.StructType([T.StructField("source", T.StringType()), T.StructField("target", T.StringType())])

# Above this many entries a mapping is joined as a table instead of being inlined in the expression.
INLINE_MAPPING_LIMIT = 200


def first_wins(sources: Sequence[str], targets: Sequence[str]) -> dict[str, str]:
    """Pair two equally long lists; a repeated source keeps its first target."""
    if len(sources) != len(targets):
        raise ValueError(f"{len(sources)} source names but {len(targets)} target names")
    mapping: dict[str, str] = {}
    for source, target in zip(sources, targets):
        mapping.setdefault(source, target)
    return mapping


def sources_by_target(mapping: Mapping[str, str]) -> dict[str, list[str]]:
    """Invert a mapping: each target with all of its sources, in first-seen order."""
    grouped: dict[str, list[str]] = {}
    for source, target in mapping.items():
        grouped.setdefault(target, []).append(source)
    return grouped


def recode(category: Column | str, mapping: Mapping[str, str], default: str | None = UNKNOWN) -> Column:
    """Target label of a category value; ``default`` for values the mapping lacks and for null.

    One ``IN`` branch per target keeps the expression inside whole-stage code generation.
    """
    value = F.col(category) if isinstance(category, str) else category
    label = F.lit(default)
    for target, sources in reversed(sources_by_target(mapping).items()):
        label = F.when(value.isin(sources), F.lit(target)).otherwise(label)
    return label


def recode_with_table(
    df: DataFrame, category: str, mapping: DataFrame, source: str, target: str, alias: str, default: str | None = UNKNOWN
) -> DataFrame:
    """Recode through a mapping table, for mappings too large to inline.

    A source with several rows has the least of its targets, so facts are never multiplied. No hint is given: Spark broadcasts the mapping only when its measured
    size is below the session's broadcast threshold, and otherwise shuffles with adaptive skew handling.
    """
    lookup = mapping.select(F.col(source).alias("__source"), F.col(target).alias("__target"))
    lookup = lookup.groupBy("__source").agg(F.min("__target").alias("__target"))
    joined = df.join(lookup, df[category] == lookup["__source"], "left")
    return joined.select(*df.columns, F.coalesce("__target", F.lit(default)).alias(alias))


def add_category(
    df: DataFrame, category: str, mapping: Mapping[str, str], alias: str = "Type", default: str | None = UNKNOWN
) -> DataFrame:
    """``df`` plus the recoded category; picks the inline or the table form by the mapping's size."""
    if len(mapping) <= INLINE_MAPPING_LIMIT:
        return df.withColumn(alias, recode(category, mapping, default))
    table = local_frame(df.sparkSession, list(mapping.items()), MAPPING_SCHEMA)
    return recode_with_table(df, category, table, "source", "target", alias, default)


def usable_rows(
    key: Column | str | None = None,
    junk_keys: Iterable[str] = ("0",),
    label: Column | str | None = None,
    default: str = UNKNOWN,
    measure: Column | str | None = None,
) -> Column:
    """Predicate for rows that take part in the per-key summaries.

    Keys listed in ``junk_keys``, the default label and non-positive measures are out. A null key, label or measure
    makes the predicate null, which a filter drops and ``count_if`` does not count.
    """

    def as_column(value: Column | str) -> Column:
        return F.col(value) if isinstance(value, str) else value

    predicate = F.lit(True)
    if key is not None:
        for junk in junk_keys:
            predicate = predicate & (as_column(key) != F.lit(junk))
    if label is not None:
        predicate = predicate & (as_column(label) != F.lit(default))
    if measure is not None:
        predicate = predicate & (as_column(measure) > 0)
    return predicate
