"""cardmarts: card-transaction medallion marts as plain Spark DataFrame operators.

Layers: raw landing files -> bronze (text + lineage) -> silver (typed, masked,
deduplicated star schema) -> gold (fraud and customer-risk marts).
"""

from cardmarts.operators import attach_fraud_labels, fraud_totals, keep_latest
from cardmarts.plans.gold import (
    build_customer_risk_profile,
    build_fraud_summary_by_mcc,
    build_fraud_summary_by_state,
    build_monthly_transaction_trends,
)
from cardmarts.plans.run import Lake, register_layers, run_all, run_layer
from cardmarts.plans.silver import (
    build_dim_card,
    build_dim_customer,
    build_dim_mcc,
    build_fact_transactions,
)
from cardmarts.session import apply_conf, scale_conf
from cardmarts.sources import read_landing

__version__ = "0.1.0"

__all__ = [
    "Lake", "apply_conf", "attach_fraud_labels", "build_customer_risk_profile", "build_dim_card",
    "build_dim_customer", "build_dim_mcc", "build_fact_transactions", "build_fraud_summary_by_mcc",
    "build_fraud_summary_by_state", "build_monthly_transaction_trends", "fraud_totals",
    "keep_latest", "read_landing", "register_layers", "run_all", "run_layer", "scale_conf",
]
