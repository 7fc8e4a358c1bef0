"""Money sums, rates and the risk tier.

Money columns are doubles (as in the source), but sums run over a wide
decimal with six digits after the point: amounts add up exactly, so the result
does not depend on the order in which partitions are merged, and rounding
comes after the sum. A value that the decimal cannot hold (NaN, infinite, or
beyond 10^24) is no amount: it is skipped like a null and flagged
``invalid_amount``. Rates are rounded half up in decimal arithmetic rather
than by rounding a double, which can land on either side of a tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(30,6)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_money(col: str | Column) -> Column:
    """A money column as an exact decimal; null where it cannot hold the value."""
    return _c(col).try_cast(MONEY)


def money_sum(col: str | Column) -> Column:
    """Exact sum of a money column as double; what is no amount is skipped, all-null gives null."""
    return F.sum(as_money(col)).cast("double")


def fraud_count(flag: str | Column = "is_fraud") -> Column:
    """Rows where the flag is true; null counts as not fraud."""
    return F.count_if(F.coalesce(_c(flag), F.lit(False)))


def fraud_amount_sum(amount: str | Column = "amount", flag: str | Column = "is_fraud") -> Column:
    """Sum of amount over fraud rows; other rows add 0, a fraud row with no amount adds nothing."""
    return money_sum(F.when(_c(flag) == F.lit(True), _c(amount)).otherwise(F.lit(0.0)))


def half_up_div(num: Column, den: Column) -> Column:
    """``num / den`` rounded half away from zero to a whole number; decimals, den > 0."""
    q = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def rate_pct(part: str | Column, total: str | Column) -> Column:
    """``round(part / total * 100, 2)`` half up, exactly; null when total is null or 0."""
    p, t = _c(part).cast("decimal(20,0)"), _c(total).cast("decimal(20,0)")
    return F.when(t > 0, half_up_div(p * 10000, t) / F.lit(100.0))


def money_avg(col: str | Column) -> Column:
    """``round(avg(col), 2)`` half up over the exact amounts, however large they are."""
    m = as_money(col)
    total, n = F.sum(m), F.count(m)
    size, per = F.abs(total), F.greatest(n, F.lit(1)).cast("decimal(20,0)")
    # the sum's whole part, what of it is left over by n, and its millionths: no step needs more than 38 digits
    whole = F.floor(size)
    left = (whole % per).cast("decimal(20,0)")
    millionths = ((size - whole).cast("decimal(7,6)") * 1_000_000).cast("decimal(7,0)")
    cents = half_up_div(left * 1_000_000 + millionths, per * 10_000)
    each = ((whole - left) / per).cast("decimal(33,0)") * 100 + cents.cast("decimal(4,0)")
    return F.when(n > 0, F.signum(total) * (each / F.lit(100).cast("decimal(3,0)")).cast("double"))


# Tier names and the bound of the middle tier (percent).
TIER_LOW, TIER_MEDIUM, TIER_HIGH = "Low", "Medium", "High"
MEDIUM_MAX_PCT = 5


def risk_tier(rate: str | Column) -> Column:
    """0 is Low, up to and including 5 is Medium, above is High; a null rate is High."""
    r = _c(rate)
    return (
        F.when(r == 0, F.lit(TIER_LOW))
        .when(r <= MEDIUM_MAX_PCT, F.lit(TIER_MEDIUM))
        .otherwise(F.lit(TIER_HIGH))
    )
