"""Landing folders and the bronze ingest of one entity for one date.

Layout: ``<landing_root>/<entity>/ingestion_date=<YYYY-MM-DD>/<files>``. The
reader points inside the date folder, so only that date is read and the
folder value reaches bronze as a literal, not as a discovered column.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.functions.audit import add_bronze_lineage
from cardmarts.schemas import CSV_ENTITIES, ENTITIES, JSON_ENTITIES, SOURCE_FORMATS
from cardmarts.sources.files import (
    SOURCE_FILE,
    SourceMissing,
    read_csv_entity,
    read_json_dictionary,
    read_json_dictionary_whole,
)


def landing_path(landing_root: str, entity: str, ingestion_date: str) -> str:
    return f"{landing_root.rstrip('/')}/{entity}/ingestion_date={ingestion_date}"


def check_ingest_args(entity: str, source_format: str | None = None) -> str:
    """Allow-list check; returns the entity's format."""
    if entity not in ENTITIES:
        raise ValueError(f"Unsupported entity: {entity}")
    fmt = "json" if entity in JSON_ENTITIES else "csv"
    if source_format is not None:
        if source_format not in SOURCE_FORMATS:
            raise ValueError(f"Unsupported source format: {source_format}")
        if source_format != fmt:
            raise ValueError(f"{entity} is delivered as {fmt}, not {source_format}")
    return fmt


def read_landing(
    spark: SparkSession,
    landing_root: str,
    entity: str,
    ingestion_date: str,
    source_format: str | None = None,
    whole: bool = False,
    file_glob: str = "*.json",
    folder: str | None = None,
) -> DataFrame:
    """Bronze rows of one entity and date: entity columns then the four lineage columns.

    Fails with ``SourceMissing`` when the date folder is absent (the presence
    check runs before any job starts). JSON dictionaries are read in splits,
    at every size alike; ``whole`` reads each file in one task instead.
    ``folder`` names the entity's landing folder where it differs from the entity.
    """
    check_ingest_args(entity, source_format)
    path = landing_path(landing_root, folder or entity, ingestion_date)
    try:
        if entity in CSV_ENTITIES:
            df = read_csv_entity(spark, path, entity)
        else:
            root, key, value = JSON_ENTITIES[entity]
            if whole:
                df = read_json_dictionary_whole(spark, path, key, value, root, file_glob)
            else:
                df = read_json_dictionary(spark, path, key, value, root, file_glob)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceMissing(f"landing folder missing: {path}") from e
        raise
    bronze = add_bronze_lineage(df, entity, ingestion_date, source_file=F.col(SOURCE_FILE))
    return bronze.drop(SOURCE_FILE)
