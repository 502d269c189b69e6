"""The layers as DataFrame plans, free of reading and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow import schemas
from tierflow.functions.days import day_sets, days_in_all, days_in_sets, is_list
from tierflow.functions.recode import add_category, recode, usable_rows
from tierflow.operators import rfm
from tierflow.operators.pivot import category_pivot, pivot_sums
from tierflow.operators.ranking import top_categories
from tierflow.plans.config import LayerConfig
from tierflow.runtime import materialize
from tierflow.sources.json_logs import flatten_hits


def bronze(hits: DataFrame, **options) -> DataFrame:
    """Wide rows of the raw documents."""
    return flatten_hits(hits, **options)


def categorized(rows: DataFrame, config: LayerConfig, alias: str = "Type") -> DataFrame:
    """Key, measure and recoded category of the usable rows."""
    typed = add_category(rows.select(config.key, config.category, config.measure), config.category, config.mapping, alias, config.default)
    usable = usable_rows(config.key, config.junk_keys, alias, config.default, config.measure)
    return typed.filter(usable).select(config.key, config.measure, alias)


def ranked_columns(config: LayerConfig) -> list[Column]:
    return top_categories(config.ranked, schemas.MOST_WATCHED_COLUMNS)


def silver(rows: DataFrame, config: LayerConfig) -> DataFrame:
    """Measure per key and category, with the three largest categories."""
    chosen = categorized(_population(rows, config), config)
    pivoted = category_pivot(chosen, config.key, "Type", config.measure, config.columns)
    return pivoted.select(config.key, *config.columns, *ranked_columns(config))


def _population(rows: DataFrame, config: LayerConfig) -> DataFrame:
    """All rows, or only those with a real key and a positive measure."""
    if config.population == "all":
        return rows
    present = F.col(config.key) != F.lit("")
    return rows.filter(usable_rows(config.key, config.junk_keys, measure=config.measure) & present)


def rfm_table(rows: DataFrame, config: LayerConfig, period: rfm.Period | None = None) -> DataFrame:
    """Metrics and scores per key. The metrics are written once: scoring reads them several times."""
    metrics = rfm.rfm_metrics(
        _population(rows, config), config.key, config.date, config.measure, config.report_date, config.total_days, period
    )
    return score(materialize(metrics, "rfm"), config)


def score(metrics: DataFrame, config: LayerConfig) -> DataFrame:
    return rfm.score(
        metrics,
        config.key,
        config.buckets,
        config.score_within,
        config.invert_recency,
    )


def gold(silver_table: DataFrame, rfm_scores: DataFrame, config: LayerConfig) -> DataFrame:
    """Inner join of the silver columns with the scores."""
    return silver_table.join(rfm_scores, config.key, "inner").select(
        config.key, *config.columns, *schemas.MOST_WATCHED_COLUMNS, *rfm.SCORES
    )


def summary(rows: DataFrame, config: LayerConfig, period: rfm.Period | None = None) -> DataFrame:
    """Everything silver, rfm and gold need, in one scan and one aggregation by key.

    Scoring looks at the whole population and the pivot at the usable rows, so the pivot sums carry that condition themselves and
    ``usable`` counts the rows that met it. Columns of ``score_within`` are carried along, by their least value per key. The group of the null key stays: its dates belong to the period.
    """
    carried = [name for name in config.score_within if name != config.key]
    typed = _population(rows, config).select(
        config.key,
        config.date,
        config.measure,
        recode(config.category, config.mapping, config.default).alias("__type"),
        *carried,
    )
    usable = usable_rows(config.key, config.junk_keys, "__type", config.default, config.measure)
    label = F.when(usable, F.col("__type"))
    if period is not None:
        days = [held.alias(f"__days_{i}") for i, held in enumerate(day_sets(F.col(config.date), *period))]
    else:
        days = [F.count_distinct(config.date).alias("__days")]
    return typed.groupBy(config.key).agg(
        *pivot_sums(label, config.measure, config.columns),
        F.count_if(usable).alias("__usable"),
        F.max(config.date).alias("__latest"),
        F.sum(config.measure).alias(rfm.METRICS[2]),
        *[F.min(name).alias(name) for name in carried],
        *days,
    )


def metrics_of(summed: DataFrame, rows: DataFrame, config: LayerConfig) -> DataFrame:
    """The rfm metrics beside the other columns of a materialised summary."""
    sets = [name for name in summed.columns if name.startswith("__days_")]
    listed = bool(sets) and is_list(summed.schema[sets[0]].dataType)
    days = days_in_sets([F.col(name) for name in sets], listed) if sets else F.col("__days")
    if config.total_days is not None:
        total = F.lit(config.total_days)
    elif sets:
        total = days_in_all(summed, sets, listed).scalar()
    else:
        # One number, and the profile is read several times: count it once instead of in every plan.
        total = F.lit(rfm.period_days(_population(rows, config), config.date).first()[0])
    return summed.filter(F.col(config.key).isNotNull()).select(
        "*",
        F.datediff(F.lit(rfm.as_date(config.report_date)), F.col("__latest")).alias(rfm.METRICS[0]),
        rfm.frequency(days, total).alias(rfm.METRICS[1]),
    )


def profile(rows: DataFrame, config: LayerConfig, period: rfm.Period | None = None) -> DataFrame:
    """Scored summary of every key: one scan of ``rows``, no self-join, no join of silver and rfm.

    ``silver_of``, ``rfm_of`` and ``gold_of`` take their rows and columns from it. The summary is materialised, since
    scoring reads it several times and the three tables share it.
    """
    return scored(materialize(summary(rows, config, period), "summary"), rows, config)


def scored(summed: DataFrame, rows: DataFrame, config: LayerConfig) -> DataFrame:
    """The profile of an already materialised summary of ``rows``."""
    return score(metrics_of(summed, rows, config), config)


def silver_of(profiled: DataFrame, config: LayerConfig) -> DataFrame:
    return profiled.filter(F.col("__usable") > 0).select(config.key, *config.columns, *ranked_columns(config))


def rfm_of(profiled: DataFrame, config: LayerConfig) -> DataFrame:
    return profiled.select(config.key, *rfm.METRICS, *rfm.SCORES)


def gold_of(profiled: DataFrame, config: LayerConfig) -> DataFrame:
    return profiled.filter(F.col("__usable") > 0).select(
        config.key, *config.columns, *ranked_columns(config), *rfm.SCORES
    )
