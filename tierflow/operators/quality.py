"""Declarative table rules, checked in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas


@dataclass(frozen=True)
class ColumnRule:
    """Expected type of a column, whether it may be null, and an inclusive range."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    minimum: int | float | None = None
    maximum: int | float | None = None


@dataclass(frozen=True)
class TableRules:
    table: str
    columns: tuple[ColumnRule, ...]

    @classmethod
    def from_schema(
        cls, table: str, schema: T.StructType, ranges: Mapping[str, tuple[float, float]] | None = None,
        required: tuple[str, ...] = (),
    ) -> TableRules:
        """Rules for every field of a schema; ``ranges`` and ``required`` tighten single columns."""
        ranges = ranges or {}
        return cls(
            table,
            tuple(
                ColumnRule(f.name, f.dataType, f.name not in required, *ranges.get(f.name, (None, None)))
                for f in schema.fields
            ),
        )


def _score_ranges() -> dict[str, tuple[int, int]]:
    return {name: (1, 4) for name in schemas.SCORE_COLUMNS}


RULES: dict[str, TableRules] = {
    "bronze": TableRules.from_schema("bronze", schemas.BRONZE),
    "silver": TableRules.from_schema("silver", schemas.SILVER),
    "rfm": TableRules.from_schema("rfm", schemas.RFM, _score_ranges(), required=("Contract",)),
    "gold": TableRules.from_schema("gold", schemas.GOLD, _score_ranges()),
    "pivot": TableRules.from_schema(
        "pivot",
        T.StructType(
            [T.StructField("Contract", T.StringType())]
            + [T.StructField(name, T.LongType()) for name in schemas.DURATION_COLUMNS]
        ),
    ),
}


class QualityError(ValueError):
    """Raised when a table breaks its rules under the ``fail`` policy."""

    def __init__(self, table: str, failures: list[tuple[str, str, int]]):
        self.table, self.failures = table, failures
        super().__init__(f"{table}: " + ", ".join(f"{column} {rule}: {count} rows" for column, rule, count in failures))


def _violations(df: DataFrame, rules: TableRules) -> list[tuple[str, str, Column]]:
    """``(column, rule, row violates it)``. A missing or wrongly typed column is violated by every row."""
    present = {field.name: field.dataType for field in df.schema.fields}
    found: list[tuple[str, str, Column]] = []
    for rule in rules.columns:
        if rule.name not in present:
            found.append((rule.name, "present", F.lit(True)))
            continue
        typed = present[rule.name] == rule.dtype
        found.append((rule.name, "type", F.lit(not typed)))
        if not rule.nullable:
            found.append((rule.name, "not_null", F.col(rule.name).isNull()))
        if typed and (rule.minimum is not None or rule.maximum is not None):
            outside = F.lit(False)
            if rule.minimum is not None:
                outside = outside | (F.col(rule.name) < F.lit(rule.minimum))
            if rule.maximum is not None:
                outside = outside | (F.col(rule.name) > F.lit(rule.maximum))
            found.append((rule.name, "in_range", F.coalesce(outside, F.lit(False))))
    return found


def _counts(df: DataFrame, rules: TableRules) -> tuple[list[Column], list[tuple[str, str, str | None]]]:
    """Aggregates over the rows, and each rule with the name of the one that counts its failures (``None``: there are none).

    Rules the schema decides need no data: a table with only such rules is checked by its row count.
    """
    structural = set(_structural(df, rules))
    counts = [F.count(F.lit(1)).alias("rows")]
    lines: list[tuple[str, str, str | None]] = []
    for index, (column, rule, bad) in enumerate(_violations(df, rules)):
        if (column, rule) in structural:
            lines.append((column, rule, "rows"))
        elif rule == "type":
            lines.append((column, rule, None))
        else:
            counts.append(F.count_if(bad).alias(f"f{index}"))
            lines.append((column, rule, f"f{index}"))
    return counts, lines


def check(df: DataFrame, rules: TableRules) -> DataFrame:
    """``(table, column, rule, failures, rows)``, every rule counted in the same scan."""
    counts, found = _counts(df, rules)
    lines = F.array(
        *[
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), (F.col(name) if name else F.lit(0).cast("bigint")).alias("failures"))
            for column, rule, name in found
        ]
    )
    return df.agg(*counts).select(F.lit(rules.table).alias("table"), F.inline(lines), "rows")


def is_valid(df: DataFrame, rules: TableRules) -> Column:
    """Predicate: the row breaks no rule."""
    return ~reduce(lambda a, b: a | b, [bad for _, _, bad in _violations(df, rules)], F.lit(False))


def broken_rules(df: DataFrame, rules: TableRules) -> Column:
    """Names of the rules a row breaks, as ``column:rule``."""
    flags = [F.when(bad, F.lit(f"{column}:{rule}")) for column, rule, bad in _violations(df, rules)]
    return F.array_compact(F.array(*flags))


def split(df: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the other rows with the rules they break."""
    return df.filter(is_valid(df, rules)), df.filter(~is_valid(df, rules)).withColumn(
        "broken_rules", broken_rules(df, rules)
    )


POLICIES = ("fail", "quarantine", "warn")


@dataclass(frozen=True)
class Audit:
    """Row count and failures of every rule of a checked table."""

    rows: int
    counts: list[tuple[str, str, int]]

    @property
    def failures(self) -> list[tuple[str, str, int]]:
        """The broken rules."""
        return [count for count in self.counts if count[2]]


def _audit_of(row: Mapping[str, int], lines: Sequence[tuple[str, str, str | None]]) -> Audit:
    return Audit(row["rows"], [(column, rule, row[name] if name else 0) for column, rule, name in lines])


def audit(df: DataFrame, rules: TableRules) -> Audit:
    """Run a check; the driver receives one row."""
    counts, lines = _counts(df, rules)
    return _audit_of(df.agg(*counts).first().asDict(), lines)


def audited(df: DataFrame, rules: TableRules) -> tuple[DataFrame, Callable[[], Audit | None]]:
    """``df`` with the rules counted by the job that consumes it, and a call that gives the audit after that job.

    The job has to run on just this frame, once. The call gives ``None`` if the job needed no row of it.
    """
    counts, lines = _counts(df, rules)
    seen = Observation()

    def result() -> Audit | None:
        row = seen.get
        return _audit_of(row, lines) if "rows" in row else None

    return df.observe(seen, *counts), result


def enforce(
    df: DataFrame, rules: TableRules, policy: str = "fail", found: Audit | None = None
) -> tuple[DataFrame, DataFrame | None, Audit]:
    """Check a materialised frame and apply the policy: ``(rows to publish, quarantined rows or None, audit)``.

    ``fail`` raises, ``quarantine`` sets the bad rows apart, ``warn`` keeps them. A column that is missing or has another
    type always raises: no row of such a table could be kept. ``found`` is the audit, if it was already made.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy {policy!r} is none of {POLICIES}")
    found = found or audit(df, rules)
    structural = _structural(df, rules)
    if structural or (found.failures and policy == "fail"):
        raise QualityError(rules.table, found.failures or [(column, rule, found.rows) for column, rule in structural])
    if found.failures and policy == "quarantine":
        valid, invalid = split(df, rules)
        return valid, invalid, found
    return df, None, found


def _structural(df: DataFrame, rules: TableRules) -> list[tuple[str, str]]:
    """Missing or wrongly typed columns, known without reading a row."""
    types = {field.name: field.dataType for field in df.schema.fields}
    missing = [(rule.name, "present") for rule in rules.columns if rule.name not in types]
    return missing + [(r.name, "type") for r in rules.columns if r.name in types and types[r.name] != r.dtype]
