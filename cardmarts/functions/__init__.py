"""Column-level helpers (scalar functions, quality flags, audit columns, metrics)."""

from cardmarts.functions.audit import add_bronze_lineage, add_layer_audit
from cardmarts.functions.cleaning import (
    CARD_MASK,
    card_last4,
    clean_currency,
    error_flag,
    label_to_boolean,
    mask_card_number,
    round_coordinates,
    to_boolean,
    to_date,
    to_int,
    to_timestamp,
    year_month,
)
from cardmarts.functions.metrics import (
    as_money,
    fraud_amount_sum,
    fraud_count,
    money_avg,
    money_sum,
    rate_pct,
    risk_tier,
)
from cardmarts.functions.quality import dq_flag, dq_flags, null_rules

__all__ = [
    "CARD_MASK", "add_bronze_lineage", "add_layer_audit", "as_money", "card_last4", "clean_currency",
    "dq_flag", "dq_flags", "error_flag", "fraud_amount_sum", "fraud_count", "label_to_boolean",
    "mask_card_number", "money_avg", "money_sum", "null_rules", "rate_pct", "risk_tier",
    "round_coordinates", "to_boolean", "to_date", "to_int", "to_timestamp", "year_month",
]
