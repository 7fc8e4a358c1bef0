"""Edge rows for every column helper (hand-written small frames)."""

from pyspark.sql import functions as F

from cardmarts.functions import (
    clean_currency,
    dq_flag,
    dq_flags,
    label_to_boolean,
    mask_card_number,
    money_avg,
    rate_pct,
    risk_tier,
    round_coordinates,
    to_boolean,
    to_date,
    to_int,
    to_timestamp,
)


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {typ}")


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_currency(spark):
    df = one_col(spark, ["$1,234.50", "$-77.00", "", "abc", "($5)", None])
    assert results(df, clean_currency("s")) == [1234.5, -77.0, None, None, None, None]


def test_mask_card_number(spark):
    df = one_col(spark, ["4344676511950444", "12", "", None])
    assert results(df, mask_card_number("s")) == [
        "************0444", "************12", "************", None]


def test_to_int(spark):
    df = one_col(spark, ["12", " 7 ", "12.0", "-3.7", "1e3", "x", None])
    assert results(df, to_int("s")) == [12, 7, 12, -3, None, None, None]


def test_to_boolean(spark):
    df = one_col(spark, ["YES", "No", "y", "maybe", None])
    assert results(df, to_boolean("s")) == [True, False, True, None, None]


def test_dates_and_times(spark):
    import datetime as dt

    df = one_col(spark, ["2002-09-01", "09/2002", "2002-09", "1998-10-03 00:00:00", "unknown"])
    assert results(df, to_date("s")) == [
        dt.date(2002, 9, 1), None, dt.date(2002, 9, 1), dt.date(1998, 10, 3), None]
    assert results(df, to_timestamp("s"))[3] == dt.datetime(1998, 10, 3)
    assert results(df, to_timestamp("s"))[4] is None


def test_round_coordinates_half_up(spark):
    df = one_col(spark, ["-32.125", "71.005", "abc", "40.7128"])
    assert results(df, round_coordinates("s")) == [-32.13, 71.01, None, 40.71]


def test_label_to_boolean(spark):
    df = one_col(spark, ["Yes", "No", "yes", None])
    assert results(df, label_to_boolean("s")) == [True, False, None, None]


def test_dq_flags_empty_and_order(spark):
    df = one_col(spark, ["a", None])
    flags = dq_flags(dq_flag(F.col("s").isNull(), "first"), dq_flag(F.lit(True), "second"),
                     dq_flag(F.col("s").isNull(), "third"))
    assert results(df, flags) == [["second"], ["first", "second", "third"]]
    none = dq_flags(dq_flag(F.lit(False), "x"))
    assert results(df, none) == [[], []]


def test_risk_tier(spark):
    df = one_col(spark, [0.0, 5.0, 5.01, None], "double")
    assert results(df, risk_tier("s")) == ["Low", "Medium", "High", "High"]


def test_rate_pct_exact_half_up(spark):
    rows = [(1, 800), (1, 8), (0, 5), (2, 3), (7, 7)]
    df = spark.createDataFrame(rows, "f long, t long").withColumn("i", F.monotonically_increasing_id())
    got = results(df, rate_pct("f", "t"))
    assert got == [0.13, 12.5, 0.0, 66.67, 100.0]


def test_money_avg_half_up_and_null(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 0.0), ("b", None), ("c", -0.015), ("c", 0.0)],
                               "g string, x double")
    out = {r.g: r.a for r in df.groupBy("g").agg(money_avg("x").alias("a")).collect()}
    # rounded after the mean: 0.0025 -> 0.00, -0.0075 -> -0.01
    assert out == {"a": 0.0, "b": None, "c": -0.01}
