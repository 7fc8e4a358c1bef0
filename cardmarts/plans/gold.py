"""Gold marts over the silver star schema.

Each mart aggregates first and joins dimensions afterwards, so only one row
per group crosses a join. No side is broadcast on a guess: AQE turns a join
into a broadcast at run time when the measured size of a side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the sort-merge
join otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmarts.functions.audit import add_layer_audit
from cardmarts.functions.metrics import money_avg, risk_tier
from cardmarts.operators.aggregates import fraud_totals

LAYER = "gold"


def build_fraud_summary_by_state(
    fact: DataFrame, load_date: str, table_name: str = "fraud_summary_by_state"
) -> DataFrame:
    """Fraud totals per merchant_state (a null state is its own group)."""
    df = fraud_totals(fact, ["merchant_state"])
    return add_layer_audit(df, load_date, table_name, LAYER)


def build_fraud_summary_by_mcc(
    fact: DataFrame, dim_mcc: DataFrame, load_date: str, table_name: str = "fraud_summary_by_mcc"
) -> DataFrame:
    """Fraud totals per mcc_code, then the description; an unknown code keeps a null one."""
    df = fraud_totals(fact, ["mcc_code"]).join(
        dim_mcc.select("mcc_code", "mcc_description"), on="mcc_code", how="left"
    )
    return add_layer_audit(df, load_date, table_name, LAYER)


def build_monthly_transaction_trends(
    fact: DataFrame, load_date: str, table_name: str = "monthly_transaction_trends"
) -> DataFrame:
    """Totals, average amount and distinct customers per (txn_year, txn_month).

    The distinct count is exact. Spark plans it as an aggregate on
    (year, month, customer_id) first, which map tasks pre-reduce, and then a
    count per month; no row is expanded.
    """
    df = fraud_totals(
        fact,
        ["txn_year", "txn_month"],
        with_fraud_amount=False,
        extra=[
            money_avg("amount").alias("avg_transaction_amount"),
            F.count_distinct("customer_id").alias("unique_customers"),
        ],
    )
    return add_layer_audit(df, load_date, table_name, LAYER)


def cards_per_customer(dim_card: DataFrame) -> DataFrame:
    """Number of cards per customer_id."""
    return dim_card.groupBy("customer_id").agg(F.count(F.lit(1)).alias("num_cards"))


def build_customer_risk_profile(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_card: DataFrame,
    load_date: str,
    table_name: str = "customer_risk_profile",
) -> DataFrame:
    """One row per customer: activity totals, card count and risk tier.

    Both right sides are aggregated on customer_id, so they arrive hash
    partitioned on the join key and the second join reuses the first one's
    partitioning; inputs bucketed on customer_id (``save_bucketed``) are not
    shuffled at all. A customer with no transactions has a null rate, hence High.
    Customers without an id match nothing and go around the joins, so they do
    not all meet in one task.
    """
    txn = fraud_totals(fact.filter("customer_id IS NOT NULL"), ["customer_id"], amount_name="total_spend", with_fraud_amount=False)
    cards = cards_per_customer(dim_card.filter("customer_id IS NOT NULL"))
    every = dim_customer.select("customer_sk", "customer_id", "current_age", "credit_score", "yearly_income")
    known = every.filter("customer_id IS NOT NULL").join(txn, "customer_id", "left").join(cards, "customer_id", "left")
    nameless = every.filter("customer_id IS NULL")
    df = known.unionByName(nameless, allowMissingColumns=True).withColumn("risk_tier", risk_tier("fraud_rate_pct"))
    # the join column comes first, as before
    df = df.select("customer_id", *[c for c in df.columns if c != "customer_id"])
    return add_layer_audit(df, load_date, table_name, LAYER)


# table -> (builder, silver inputs in argument order)
GOLD_TABLES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "fraud_summary_by_state": (build_fraud_summary_by_state, ("fact_transactions",)),
    "fraud_summary_by_mcc": (build_fraud_summary_by_mcc, ("fact_transactions", "dim_mcc")),
    "monthly_transaction_trends": (build_monthly_transaction_trends, ("fact_transactions",)),
    "customer_risk_profile": (
        build_customer_risk_profile,
        ("fact_transactions", "dim_customer", "dim_card"),
    ),
}
