"""Sinks: table writes and versions, registration, views, inventory, run log."""

from cardmarts.sinks.runlog import log_step, new_run_id, read_log, run_context
from cardmarts.sinks.tables import (
    Written,
    bucket_count,
    compact_table,
    create_catalog_views,
    create_schema,
    create_serving_views,
    current_path,
    drop_old_versions,
    layer_inventory,
    publish_table,
    read_stats,
    read_table,
    register_table,
    save_bucketed,
    top_n,
    write_table,
)

__all__ = [
    "Written", "bucket_count", "compact_table", "create_catalog_views", "create_schema", "create_serving_views", "current_path",
    "drop_old_versions",
    "layer_inventory", "log_step", "new_run_id", "publish_table", "read_log", "read_stats", "read_table",
    "register_table", "run_context", "save_bucketed", "top_n", "write_table",
]
