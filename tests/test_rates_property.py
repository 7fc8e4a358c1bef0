"""Exact half-up rounding of rates against Python's Fraction arithmetic."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardmarts.functions import rate_pct


def half_up(x: Fraction, digits: int) -> float:
    scaled = x * 10 ** digits
    n = int(scaled)  # truncates toward zero
    if abs(scaled - n) * 2 >= 1:
        n += 1 if scaled > 0 else -1
    return n / 10 ** digits


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=200))
def test_rate_pct_matches_fraction(spark, pairs):
    rows = [(min(f, t), t) for f, t in pairs]
    df = spark.createDataFrame(rows, "f long, t long")
    got = [r[0] for r in df.select(rate_pct("f", "t")).collect()]
    want = [half_up(Fraction(f * 100, t), 2) for f, t in rows]
    assert got == want


def test_rate_pct_null_total(spark):
    df = spark.createDataFrame([(1, None), (0, 0)], "f long, t long")
    assert [r[0] for r in df.select(rate_pct(F.col("f"), F.col("t"))).collect()] == [None, None]
