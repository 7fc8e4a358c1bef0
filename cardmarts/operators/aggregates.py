"""Grouped fraud totals shared by the gold marts.

Every total is a plain aggregate, so Spark computes a partial aggregate in
each map task before the shuffle: a group that holds a third of all rows is
reduced to one row per task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmarts.functions.metrics import fraud_amount_sum, fraud_count, money_sum, rate_pct


def fraud_totals(
    fact: DataFrame,
    keys: Sequence[str],
    amount_name: str = "total_amount",
    with_fraud_amount: bool = True,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per group: total_transactions, total_fraud_transactions, amount sum,
    optionally total_fraud_amount and ``extra`` aggregates, then fraud_rate_pct.

    The rate divides by *all* rows of the group, unlabelled ones included.
    """
    aggs = [
        F.count(F.lit(1)).alias("total_transactions"),
        fraud_count("is_fraud").alias("total_fraud_transactions"),
        money_sum("amount").alias(amount_name),
    ]
    if with_fraud_amount:
        aggs.append(fraud_amount_sum("amount", "is_fraud").alias("total_fraud_amount"))
    aggs.extend(extra)
    return fact.groupBy(*keys).agg(*aggs).withColumn(
        "fraud_rate_pct", rate_pct("total_fraud_transactions", "total_transactions")
    )
