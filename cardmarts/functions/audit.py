"""Lineage columns for bronze and audit columns for silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_bronze_lineage(
    df: DataFrame, entity: str, ingestion_date: str, source_file: Column | str | None = None
) -> DataFrame:
    """Append ``_ingested_at``, ``_ingestion_date``, ``_source_file`` and ``_batch_id``.

    ``source_file`` defaults to the scan's own file path (``_metadata``), which
    every file source offers, text and CSV alike.
    """
    if source_file is None:
        src = F.col("_metadata.file_path")
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_ingestion_date": F.lit(ingestion_date),
        "_source_file": src,
        "_batch_id": F.lit(f"{entity}_{ingestion_date}"),
    })


def add_layer_audit(df: DataFrame, load_date: str, table_name: str, layer: str) -> DataFrame:
    """Append ``_<layer>_loaded_at``, ``_load_date``, ``_table`` and ``_batch_id``."""
    return df.withColumns({
        f"_{layer}_loaded_at": F.current_timestamp(),
        f"_{layer}_load_date": F.lit(load_date),
        f"_{layer}_table": F.lit(table_name),
        f"_{layer}_batch_id": F.lit(f"{table_name}_{load_date}"),
    })
