"""Fixed schemas: raw landing entities, control configs and the run log.

Raw CSV entities are read with an explicit all-string schema; nothing is
inferred. Columns are matched by position, so the order below is the file
order.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Column names and order of the raw CSV entities.
TRANSACTIONS = _strings(
    "id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id",
    "merchant_city", "merchant_state", "zip", "mcc", "errors",
)
USERS = _strings(
    "id", "current_age", "retirement_age", "birth_year", "birth_month", "gender",
    "address", "latitude", "longitude", "per_capita_income", "yearly_income",
    "total_debt", "credit_score", "num_credit_cards",
)
CARDS = _strings(
    "id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv",
    "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
    "year_pin_last_changed", "card_on_dark_web",
)

CSV_ENTITIES: dict[str, StructType] = {
    "transactions": TRANSACTIONS,
    "users": USERS,
    "cards": CARDS,
}

# JSON dictionary entities: (root object or None, key column, value column).
JSON_ENTITIES: dict[str, tuple[str | None, str, str]] = {
    "fraud_labels": ("target", "transaction_id", "is_fraud_label"),
    "mcc_codes": (None, "mcc_code", "mcc_description"),
}

ENTITIES = frozenset(CSV_ENTITIES) | frozenset(JSON_ENTITIES)
SOURCE_FORMATS = frozenset({"csv", "json"})

STRING_MAP = MapType(StringType(), StringType())

# Bronze lineage columns, appended after the entity columns.
LINEAGE_COLUMNS = ("_ingested_at", "_ingestion_date", "_source_file", "_batch_id")

DQ_FLAGS_TYPE = ArrayType(StringType())

ENTITY_CONFIG = StructType([
    StructField("entity", StringType(), True),
    StructField("landing_folder", StringType(), True),
    StructField("source_format", StringType(), True),
    StructField("is_active", BooleanType(), True),
])
SILVER_CONFIG = StructType([
    StructField("silver_table", StringType(), True),
    StructField("bronze_source", ArrayType(StringType()), True),
    StructField("is_active", BooleanType(), True),
])
GOLD_CONFIG = StructType([
    StructField("gold_table", StringType(), True),
    StructField("silver_source", ArrayType(StringType()), True),
    StructField("is_active", BooleanType(), True),
])

# Run log; row_count is 64-bit so large writes never overflow it.
RUN_LOG = StructType([
    StructField("run_id", StringType(), True),
    StructField("pipeline_layer", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("step_name", StringType(), True),
    StructField("status", StringType(), True),
    StructField("logged_at", TimestampType(), True),
    StructField("row_count", LongType(), True),
    StructField("error_message", StringType(), True),
    StructField("job_name", StringType(), True),
    StructField("triggered_by", StringType(), True),
    StructField("load_type", StringType(), True),
    StructField("job_id", StringType(), True),
    StructField("job_run_id", StringType(), True),
])
