"""Configuration of the layered batch job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tierflow import schemas
from tierflow.functions.recode import UNKNOWN, first_wins, sources_by_target
from tierflow.operators import quality

# Application names and the duration column each one feeds. The first match wins.
APP_NAMES = ("CHANNEL", "KPLUS", "VOD", "FIMS", "BHD", "SPORT", "CHILD", "RELAX")
COLUMN_NAMES = (
    "TVDuration",
    "TVDuration",
    "MovieDuration",
    "MovieDuration",
    "MovieDuration",
    "SportDuration",
    "ChildDuration",
    "RelaxDuration",
)

# Label of each duration column, in the order that decides ties of the arg-max.
LABELS = {
    "ChildDuration": "Child",
    "MovieDuration": "Movie",
    "RelaxDuration": "Relax",
    "SportDuration": "Sport",
    "TVDuration": "TV",
}


@dataclass(frozen=True)
class LayerConfig:
    """Column names, category mapping and scoring of one set of layers."""

    report_date: dt.date | str
    mapping: Mapping[str, str] = field(default_factory=lambda: first_wins(APP_NAMES, COLUMN_NAMES))
    columns: tuple[str, ...] = schemas.DURATION_COLUMNS
    labels: Mapping[str, str] = field(default_factory=lambda: dict(LABELS))
    key: str = "Contract"
    category: str = "AppName"
    measure: str = "TotalDuration"
    date: str = "Date"
    junk_keys: tuple[str, ...] = ("0",)
    default: str = UNKNOWN
    total_days: int | None = None
    buckets: int = 4
    score_within: tuple[str, ...] = ()
    invert_recency: bool = False
    population: str = "all"
    partition_by: tuple[str, ...] = ("Date",)
    policy: str = "fail"

    def __post_init__(self):
        if self.population not in ("all", "usable"):
            raise ValueError("population is 'all' or 'usable'")

    @property
    def targets(self) -> dict[str, list[str]]:
        """Every target column with its source categories; columns without a source have none."""
        grouped = sources_by_target(self.mapping)
        return {column: grouped.get(column, []) for column in self.columns}

    def rules(self, table: str) -> quality.TableRules:
        """Audit rules of a layer, in terms of this configuration's columns and buckets."""
        if table == "bronze":
            return quality.RULES["bronze"]
        key = T.StructField(self.key, T.StringType())
        measures = [T.StructField(name, T.LongType()) for name in self.columns]
        ranked = [T.StructField(name, T.StringType()) for name in schemas.MOST_WATCHED_COLUMNS]
        scores = [T.StructField(name, T.IntegerType()) for name in schemas.SCORE_COLUMNS]
        metrics = [f for f in schemas.RFM.fields if f.name not in ("Contract", *schemas.SCORE_COLUMNS)]
        fields = {"silver": measures + ranked, "rfm": metrics + scores, "gold": measures + ranked + scores, "pivot": measures}[table]
        ranges = {name: (1, self.buckets) for name in schemas.SCORE_COLUMNS}
        required = (self.key,) if table == "rfm" else ()
        return quality.TableRules.from_schema(table, T.StructType([key, *fields]), ranges, required)

    @property
    def ranked(self) -> dict[str, str]:
        """Columns and labels in label order."""
        ordered = sorted(self.columns, key=lambda column: self.labels.get(column, column))
        return {column: self.labels.get(column, column) for column in ordered}
