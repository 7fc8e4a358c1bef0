"""Control configs: one JSON array per layer listing the tables to build.

The packaged configs are read on the driver through the package itself, so
they are found in a zip given to ``--py-files`` as well. A ``config_root``
names a folder with files of the same names on shared storage instead, which
Spark reads. Either way only a handful of rows reach the driver.
"""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cardmarts.schemas import ENTITY_CONFIG, GOLD_CONFIG, SILVER_CONFIG

# layer -> (file, schema, name column)
_CONFIGS = {
    "bronze": ("entities.json", ENTITY_CONFIG, "entity"),
    "silver": ("silver_tables.json", SILVER_CONFIG, "silver_table"),
    "gold": ("gold_tables.json", GOLD_CONFIG, "gold_table"),
}


def read_config(spark: SparkSession, layer: str, path: str | None = None) -> DataFrame:
    """The layer's config rows, with a fixed schema (no inference); the packaged ones without a ``path``."""
    file, schema, _ = _CONFIGS[layer]
    if path:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    rows = json.loads(resources.files("cardmarts").joinpath("config", file).read_text())
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def active_rows(spark: SparkSession, layer: str, config_root: str | None = None) -> list[Row]:
    """The active config rows, in file order."""
    path = f"{config_root.rstrip('/')}/{_CONFIGS[layer][0]}" if config_root else None
    return read_config(spark, layer, path).filter(F.coalesce(F.col("is_active"), F.lit(False))).collect()


def active_tables(spark: SparkSession, layer: str, config_root: str | None = None) -> list[str]:
    """Names of the active rows, in file order."""
    return [r[_CONFIGS[layer][2]] for r in active_rows(spark, layer, config_root)]
