"""Sources: CSV and JSON-dictionary landing files, landing folders, control configs."""

from cardmarts.sources.config import active_rows, active_tables, read_config
from cardmarts.sources.files import (
    SourceMissing,
    read_csv_entity,
    read_json_dictionary,
    read_json_dictionary_whole,
)
from cardmarts.sources.landing import check_ingest_args, landing_path, read_landing

__all__ = [
    "SourceMissing", "active_rows", "active_tables", "check_ingest_args", "landing_path", "read_config",
    "read_csv_entity", "read_json_dictionary", "read_json_dictionary_whole", "read_landing",
]
