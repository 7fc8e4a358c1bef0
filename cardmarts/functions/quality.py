"""Row-level data-quality flags: rows are flagged, never dropped.

``dq_flags`` packs the names of the rules that hold into one array column
(in argument order, empty when the row is clean). The rule sets per silver
table follow below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardmarts.functions.metrics import as_money


def dq_flag(condition: Column, name: str) -> Column:
    """The flag name when ``condition`` is true, else null."""
    return F.when(condition, F.lit(name))


def dq_flags(*flags: Column) -> Column:
    """Array of the non-null flags, in argument order; empty (not null) when clean.

    Built as a concatenation of one-element or empty arrays rather than
    ``array_compact`` (a lambda ``filter`` that Spark cannot code-generate),
    so the projection that carries it stays inside whole-stage codegen.
    """
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(f.isNotNull(), F.array(f)).otherwise(empty) for f in flags])


# Flag names and the column each one tests for null.
CUSTOMER_RULES = (
    ("customer_id", "missing_customer_id"),
    ("yearly_income", "invalid_yearly_income"),
    ("credit_score", "missing_credit_score"),
)
CARD_RULES = (
    ("card_id", "missing_card_id"),
    ("credit_limit", "invalid_credit_limit"),
)
FACT_RULES = (
    ("amount", "invalid_amount"),
    ("transaction_datetime", "invalid_datetime"),
    ("customer_id", "missing_customer_id"),
)


# Money columns: also flagged when no exact amount can hold the value.
MONEY_COLUMNS = ("amount",)


def null_rules(rules: tuple[tuple[str, str], ...]) -> Column:
    """``dq_flags`` over "column is null" rules (for money: "is no amount")."""
    value = lambda c: as_money(c) if c in MONEY_COLUMNS else F.col(c)
    return dq_flags(*(dq_flag(value(c).isNull(), name) for c, name in rules))
