"""The whole batch job: raw JSON files to bronze, silver, rfm and gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tierflow import schemas
from tierflow.operators import rfm
from tierflow.plans import layers
from tierflow.plans.config import LayerConfig
from tierflow.runtime import delete_path, local_frame, stage
from tierflow.sinks.lake import Lake, Snapshot, file_sizes, read_snapshot
from tierflow.sinks.snapshots import Layout, publish
from tierflow.sources.json_logs import read_json_logs, split_corrupt

CORRUPT_SUFFIX = "_corrupt"


def create_layers(lake: Lake, partition_bronze_by: tuple[str, ...] = ("Date",)) -> list[str]:
    """Publish empty layer tables in a new lake, so that every layer can be queried before the first run."""
    names = []
    for table, schema in schemas.LAYERS.items():
        if lake.snapshot(table) is None:
            empty = local_frame(lake.spark, [], schema)
            publish(lake, empty, table, partition_by=partition_bronze_by if table == "bronze" else (), operation="create")
        names.append(f"{lake.database}.{table}")
    return names


def bronze_layer(lake: Lake, hits: DataFrame, config: LayerConfig, cluster: bool = True, **options) -> Snapshot:
    """Publish the bronze table, clustered by key within the date partitions; unparsable lines go to a table of their own.

    The raw files are parsed once, into a staged table that the quarantine, the clustering sample and the final write
    read.
    """
    staged, path = stage(layers.bronze(hits, **options), "bronze")
    stored = (staged.count(), file_sizes(lake.spark, [path])[1])
    if schemas.CORRUPT_COLUMN in staged.columns:
        staged, bad = split_corrupt(staged)
        publish(lake, bad, "bronze" + CORRUPT_SUFFIX, evolve=True, partition_by=())
    layout = Layout(cluster_by=(config.key,)) if cluster else Layout(compact=True)
    snapshot = publish(
        lake, staged, "bronze", partition_by=config.partition_by, rules=config.rules("bronze"), policy=config.policy,
        layout=layout, stored=stored,
    )
    delete_path(lake.spark, path)
    return snapshot


def profile_bronze(lake: Lake, config: LayerConfig) -> tuple[DataFrame, str]:
    """The scored profile of the published bronze table, and the path of the summary it reads."""
    rows = read_snapshot(lake, "bronze")
    summed, path = stage(layers.summary(rows, config, rfm.date_bounds(rows, config.date)), "summary")
    return layers.scored(summed, rows, config), path


def silver_layer(lake: Lake, config: LayerConfig, profiled: DataFrame) -> None:
    """Publish rfm and silver, side by side, from a profile of the bronze table."""
    tables = {"rfm": layers.rfm_of(profiled, config), "silver": layers.silver_of(profiled, config)}

    def write(name: str) -> Snapshot:
        return publish(lake, tables[name], name, rules=config.rules(name), policy=config.policy)

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        started = [pool.submit(inheritable_thread_target(lake.spark)(write), name) for name in tables]
        for future in started:
            future.result()


def gold_layer(lake: Lake, config: LayerConfig, profiled: DataFrame | None = None) -> Snapshot:
    """Publish gold, from the profile of this run or by joining the published silver and rfm tables."""
    if profiled is not None:
        table = layers.gold_of(profiled, config)
    else:
        table = layers.gold(read_snapshot(lake, "silver"), read_snapshot(lake, "rfm"), config)
    return publish(lake, table, "gold", rules=config.rules("gold"), policy=config.policy)


def run(
    lake: Lake,
    raw_path: str,
    config: LayerConfig,
    cluster: bool = True,
    read_options: Mapping | None = None,
    flatten_options: Mapping | None = None,
) -> DataFrame:
    """Raw JSON logs to published layers; returns the gold table."""
    hits = read_json_logs(lake.spark, raw_path, **(read_options or {}))
    bronze_layer(lake, hits, config, cluster, **(flatten_options or {}))
    profiled, path = profile_bronze(lake, config)
    silver_layer(lake, config, profiled)
    gold_layer(lake, config, profiled)
    delete_path(lake.spark, path)
    return read_snapshot(lake, "gold")
