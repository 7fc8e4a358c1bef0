"""Relational operators: keep-latest dedup, label join, grouped fraud totals."""

from cardmarts.operators.aggregates import fraud_totals
from cardmarts.operators.dedup import keep_latest
from cardmarts.operators.labels import attach_fraud_labels

__all__ = ["attach_fraud_labels", "fraud_totals", "keep_latest"]
