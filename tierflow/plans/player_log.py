"""The player log with the days of each box: literal lines, tab-separated user information, and their left join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierflow import schemas
from tierflow.operators.enrich import left_lookup
from tierflow.sources import read_keyed_tsv, read_player_log


def player_sessions(
    spark: SparkSession, log_paths: str | Sequence[str], info_paths: str | Sequence[str], fallback: bool = True
) -> DataFrame:
    """Log columns and ``Days``. Boxes without information keep a null; a box listed twice gives its log rows twice.

    Without ``fallback`` only plain lines are read, and no Python worker runs.
    """
    info = read_keyed_tsv(spark, info_paths, key=schemas.USER_INFO[0].name, value=schemas.USER_INFO[1].name)
    return left_lookup(read_player_log(spark, log_paths, fallback=fallback), info, "Mac", "MacId", ["Days"])
