from tierflow.sources.json_logs import date_from_path, flatten_hits, read_json_logs, split_corrupt
from tierflow.sources.json_variant import infer_json_lines
from tierflow.sources.tables import (
    catalog_table,
    in_date_range,
    on_days,
    partition_paths,
    read_date_range,
    read_table,
)
from tierflow.sources.text_logs import (
    parse_keyed_tsv,
    parse_literal_lines,
    read_keyed_tsv,
    read_player_log,
    read_text_lines,
    session_timestamp,
)

__all__ = [
    "catalog_table",
    "date_from_path",
    "flatten_hits",
    "in_date_range",
    "infer_json_lines",
    "on_days",
    "parse_keyed_tsv",
    "parse_literal_lines",
    "partition_paths",
    "read_date_range",
    "read_json_logs",
    "read_keyed_tsv",
    "read_player_log",
    "read_table",
    "read_text_lines",
    "session_timestamp",
    "split_corrupt",
]
