from tierflow.operators.enrich import hot_key_lookup, left_lookup
from tierflow.operators.pivot import category_pivot, conditional_pivot, grouped_pivot, ordered_by
from tierflow.operators.quality import RULES, ColumnRule, QualityError, TableRules, check, enforce
from tierflow.operators.ranking import argmax_column, ntile_exact, ntiles_exact, top_categories
from tierflow.operators.rfm import activeness, exclude_code, period_days, rfm_code, rfm_metrics, score

__all__ = [
    "RULES",
    "ColumnRule",
    "QualityError",
    "TableRules",
    "activeness",
    "argmax_column",
    "category_pivot",
    "check",
    "conditional_pivot",
    "enforce",
    "exclude_code",
    "grouped_pivot",
    "hot_key_lookup",
    "left_lookup",
    "ntile_exact",
    "ntiles_exact",
    "ordered_by",
    "period_days",
    "rfm_code",
    "rfm_metrics",
    "score",
    "top_categories",
]
