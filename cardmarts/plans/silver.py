"""Silver star schema: three dimensions and the transaction fact.

Each builder takes bronze DataFrames and returns a lazy DataFrame; nothing
runs until the caller writes it. Sensitive columns (full card number, cvv)
are never selected, so they cannot leak into silver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmarts.functions.audit import add_layer_audit
from cardmarts.functions.cleaning import (
    card_last4,
    clean_currency,
    error_flag,
    mask_card_number,
    round_coordinates,
    to_boolean,
    to_date,
    to_int,
    to_timestamp,
)
from cardmarts.functions.quality import CARD_RULES, CUSTOMER_RULES, FACT_RULES, null_rules
from cardmarts.operators.dedup import keep_latest
from cardmarts.operators.labels import attach_fraud_labels, without_labels

LAYER = "silver"

# Each table's output columns in order, with the raw column and the parser of each.
CUSTOMER_COLUMNS = (
    ("customer_id", "id", None),
    ("current_age", "current_age", to_int),
    ("retirement_age", "retirement_age", to_int),
    ("birth_year", "birth_year", to_int),
    ("birth_month", "birth_month", to_int),
    ("gender", "gender", None),
    ("address", "address", None),
    ("latitude", "latitude", round_coordinates),
    ("longitude", "longitude", round_coordinates),
    ("per_capita_income", "per_capita_income", clean_currency),
    ("yearly_income", "yearly_income", clean_currency),
    ("total_debt", "total_debt", clean_currency),
    ("credit_score", "credit_score", to_int),
    ("num_credit_cards", "num_credit_cards", to_int),
    ("_bronze_batch_id", "_batch_id", None),
)
CARD_COLUMNS = (
    ("card_id", "id", None),
    ("customer_id", "client_id", None),
    ("card_brand", "card_brand", None),
    ("card_type", "card_type", None),
    ("card_number_masked", "card_number", mask_card_number),
    ("card_number_last4", "card_number", card_last4),
    ("has_chip", "has_chip", to_boolean),
    ("card_on_dark_web", "card_on_dark_web", to_boolean),
    ("num_cards_issued", "num_cards_issued", to_int),
    ("credit_limit", "credit_limit", clean_currency),
    ("acct_open_date", "acct_open_date", to_date),
    ("year_pin_last_changed", "year_pin_last_changed", to_int),
    ("expires", "expires", None),
    ("_bronze_batch_id", "_batch_id", None),
)
MCC_COLUMNS = (
    ("mcc_code", "mcc_code", None),
    ("mcc_description", "mcc_description", None),
    ("_bronze_batch_id", "_batch_id", None),
)
TRANSACTION_COLUMNS = (
    ("transaction_id", "id", None),
    ("transaction_datetime", "date", to_timestamp),
    ("customer_id", "client_id", None),
    ("card_id", "card_id", None),
    ("amount", "amount", clean_currency),
    ("channel", "use_chip", None),
    ("merchant_id", "merchant_id", None),
    ("merchant_city", "merchant_city", None),
    ("merchant_state", "merchant_state", None),
    ("zip", "zip", None),
    ("mcc_code", "mcc", None),
    ("has_error", "errors", error_flag),
    ("error_detail", "errors", None),
    ("_bronze_batch_id_transactions", "_batch_id", None),
)


def surrogate_key() -> Column:
    """Unique, non-dense, non-negative bigint; fixed once the table is written."""
    return F.monotonically_increasing_id()


def typed(rows: DataFrame, key_name: str, columns: tuple, key: Column | None = None) -> DataFrame:
    """A surrogate key, then every listed column through its parser."""
    out = [(parse(raw) if parse else F.col(raw)).alias(name) for name, raw, parse in columns]
    return rows.select((surrogate_key() if key is None else key).alias(key_name), *out)


def build_dimension(
    raw: DataFrame, load_date: str, table: str, key_name: str, key: str, columns: tuple, rules: tuple = (),
    keep_null_keys: bool = False, tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key, typed, flagged and stamped: what the three dimensions have in common."""
    df = typed(keep_latest(raw, key, tie_break=tie_break, keep_null_keys=keep_null_keys), key_name, columns)
    if rules:
        df = df.withColumn("_dq_flags", null_rules(rules))
    return add_layer_audit(df, load_date, table, LAYER)


def build_dim_customer(users: DataFrame, load_date: str, keep_null_keys: bool = False,
                       tie_break: Sequence[str] | None = None) -> DataFrame:
    return build_dimension(users, load_date, "dim_customer", "customer_sk", "id", CUSTOMER_COLUMNS, CUSTOMER_RULES,
                           keep_null_keys, tie_break)


def build_dim_card(cards: DataFrame, load_date: str, keep_null_keys: bool = False,
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    return build_dimension(cards, load_date, "dim_card", "card_sk", "id", CARD_COLUMNS, CARD_RULES, keep_null_keys, tie_break)


def build_dim_mcc(mcc_codes: DataFrame, load_date: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    return build_dimension(mcc_codes, load_date, "dim_mcc", "mcc_sk", "mcc_code", MCC_COLUMNS, tie_break=tie_break)


def build_fact_transactions(
    transactions: DataFrame,
    fraud_labels: DataFrame,
    load_date: str,
    keep_null_keys: bool = False,
    dedup_labels: bool = False,
    hot_ids: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Deduplicated, typed transactions left-joined to their fraud label.

    Two shuffles: by id for the dedup and by transaction_id for the label
    join; the fact side keeps its partitioning through the rename, so only
    the labels move for the join. ``hot_ids`` names ids with very many labels
    (see ``hot_label_ids``). Rows of one transaction that a repeated label
    multiplies share its surrogate key, which is assigned before the join.

    ``keep_null_keys`` keeps all rows without an id. They are set apart before
    the dedup and the join, which they cannot take part in, and take the odd
    surrogate keys; all others take the even ones.

    ``by_month`` appends the partition columns and deals the rows out by them,
    as a partitioned write wants them, before the flags and the audit columns
    are added, so that the shuffle does not carry those.
    """
    keyed, even = transactions, None
    if keep_null_keys:
        keyed, even = transactions.filter(F.col("id").isNotNull()), surrogate_key() * 2
    rows = typed(keep_latest(keyed, "id", tie_break=tie_break), "transaction_sk", TRANSACTION_COLUMNS, even)
    df = attach_fraud_labels(rows, fraud_labels, dedup_labels, hot_ids)
    if keep_null_keys:
        unkeyed = typed(transactions.filter(F.col("id").isNull()), "transaction_sk", TRANSACTION_COLUMNS, surrogate_key() * 2 + 1)
        df = df.unionByName(without_labels(unkeyed, fraud_labels))
    months = PARTITION_COLUMNS["fact_transactions"]
    if by_month:
        df = with_month_partition(df).hint("rebalance", *months)
    df = df.withColumn("_dq_flags", null_rules(FACT_RULES))
    df = add_layer_audit(df, load_date, "fact_transactions", LAYER)
    return df.select(*[c for c in df.columns if c not in months], *months) if by_month else df


def with_month_partition(fact: DataFrame) -> DataFrame:
    """Append ``txn_year`` and ``txn_month``, the fact's partition columns."""
    return fact.withColumns({
        "txn_year": F.year("transaction_datetime"),
        "txn_month": F.month("transaction_datetime"),
    })


# table -> (builder, bronze inputs in argument order)
SILVER_TABLES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_customer": (build_dim_customer, ("users",)),
    "dim_card": (build_dim_card, ("cards",)),
    "dim_mcc": (build_dim_mcc, ("mcc_codes",)),
    "fact_transactions": (build_fact_transactions, ("transactions", "fraud_labels")),
}
PARTITION_COLUMNS = {"fact_transactions": ("txn_year", "txn_month")}
