from tierflow.sinks.buckets import save_bucketed, save_layers_bucketed
from tierflow.sinks.catalog import (
    analyze,
    column_statistics,
    create_table,
    create_view,
    describe,
    drop_table,
    ensure_database,
    external_table,
    register_layers,
    register_temp_view,
    sync_partitions,
)
from tierflow.sinks.lake import Lake, Snapshot, read_snapshot
from tierflow.sinks.maintenance import compact, expired_snapshots, opened_share, vacuum, zone_map, zorder
from tierflow.sinks.partitions import compact_partitions, delete_in_partitions
from tierflow.sinks.snapshots import Layout, delete_where, history, load_table, publish

__all__ = [
    "Lake",
    "Layout",
    "Snapshot",
    "analyze",
    "column_statistics",
    "compact",
    "compact_partitions",
    "create_table",
    "create_view",
    "delete_in_partitions",
    "delete_where",
    "describe",
    "drop_table",
    "ensure_database",
    "expired_snapshots",
    "external_table",
    "history",
    "load_table",
    "opened_share",
    "publish",
    "read_snapshot",
    "register_layers",
    "register_temp_view",
    "save_bucketed",
    "save_layers_bucketed",
    "sync_partitions",
    "vacuum",
    "zone_map",
    "zorder",
]
