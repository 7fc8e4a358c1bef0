"""Raw card entities derived from the driver's TPC-H-style tables.

The test tables hold no card data, so each raw entity is a Spark job over
them (all columns text, as a landing file would deliver them). Every rule
uses integer arithmetic, decimal-to-text casts, ``lpad`` and ``concat`` only,
so DuckDB derives byte-equal text for the oracle.

Rows per entity grow with the source tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.functions.audit import add_bronze_lineage

# Fixed values of the testbed: the run date and a merchant code that no part has.
RUN_DATE = "2024-01-01"
UNKNOWN_CODE = "Brand#00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _money_text(c: Column) -> Column:
    return F.concat(F.lit("$"), _s(c.cast("decimal(18,2)")))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; some amounts have three decimals, a few are beyond any decimal."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # the long names come last, so that no other join shuffles them
    j = (
        li.join(pa, li.l_partkey == pa.p_partkey)
        .join(od, li.l_orderkey == od.o_orderkey)
        .join(su, li.l_suppkey == su.s_suppkey)
        .join(na, su.s_nationkey == na.n_nationkey)
    )
    line3 = F.col("l_linenumber") % 3
    return j.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("id"),
        F.when(F.col("l_orderkey") % 251 == 0, F.lit("unknown"))
        .otherwise(_s(F.col("o_orderdate"))).alias("date"),
        _s(F.col("o_custkey")).alias("client_id"),
        _s(F.col("o_custkey") * 3 + line3).alias("card_id"),
        F.when(F.col("l_partkey") % 37 == 0, F.lit(""))
        .when((F.col("l_orderkey") % 499 == 0) & (F.col("l_linenumber") == 1), F.lit("$1e30"))
        .when(F.col("l_partkey") % 41 == 0, F.concat(_money_text(F.col("l_extendedprice")), F.lit("5")))
        .otherwise(_money_text(F.col("l_extendedprice"))).alias("amount"),
        F.when(line3 == 0, F.lit("Chip Transaction"))
        .when(line3 == 1, F.lit("Swipe Transaction"))
        .otherwise(F.lit("Online Transaction")).alias("use_chip"),
        _s(F.col("l_suppkey")).alias("merchant_id"),
        F.col("s_name").alias("merchant_city"),
        F.col("n_name").alias("merchant_state"),
        F.when(line3 == 2, F.lit(None).cast("string"))
        .otherwise(_s(F.col("l_suppkey") + 10000)).alias("zip"),
        F.when(F.col("l_partkey") % 53 == 0, F.lit(UNKNOWN_CODE)).otherwise(F.col("p_brand")).alias("mcc"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1), F.lit("Bad PIN"))
        .alias("errors"),
    )


def raw_fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per (order, line): Yes, No, or none (about a quarter unlabelled)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    label = (
        F.when((F.col("flag") == "R") & (F.col("l_orderkey") % 20 == 0), F.lit("Yes"))
        .when(F.col("flag") != "A", F.lit("No"))
    )
    return g.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("transaction_id"),
        label.alias("is_fraud_label"),
    ).filter(F.col("is_fraud_label").isNotNull())


def _user_columns(c: Column, nation: Column, acctbal: Column, address_suffix: str,
                  id_prefix: str = "") -> list[Column]:
    month = _s(c % 12 + 1)
    ident = F.concat(F.lit(id_prefix), _s(c)) if id_prefix else _s(c)
    return [
        F.when(c % 97 == 0, F.lit(None).cast("string")).otherwise(ident).alias("id"),
        _s(c % 60 + 20).alias("current_age"),
        _s(c % 10 + 60).alias("retirement_age"),
        _s(2004 - c % 60).alias("birth_year"),
        F.when(c % 5 == 0, F.concat(month, F.lit(".0"))).otherwise(month).alias("birth_month"),
        F.when(c % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.concat(_s(c), F.lit(address_suffix)).alias("address"),
        F.concat(F.lit("-"), _s(nation + 30), F.lit(".12"), _s(c % 10)).alias("latitude"),
        F.concat(_s(c % 50 + 70), F.lit("."), F.lpad(_s(c % 1000), 3, "0")).alias("longitude"),
        _money_text(acctbal).alias("per_capita_income"),
        F.when(c % 23 == 0, F.lit("n/a"))
        .otherwise(_money_text(acctbal.cast("decimal(18,2)") * 12)).alias("yearly_income"),
        F.concat(
            F.lit("$"), _s(c % 50), F.lit(","), F.lpad(_s(c * 7 % 1000), 3, "0"),
            F.lit("."), F.lpad(_s(c % 100), 2, "0"),
        ).alias("total_debt"),
        F.when(c % 17 == 0, F.lit(None).cast("string")).otherwise(_s(c % 350 + 500)).alias("credit_score"),
        _s(c % 4).alias("num_credit_cards"),
    ]


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, an older second delivery for every 7th, and for every 10th a user without activity."""
    cu = table(spark, sf_dir, "customer")
    c, nk, bal = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    current = cu.select(*_user_columns(c, nk, bal, " Main St"))
    older = cu.filter(c % 7 == 0).select(*_user_columns(c, nk, bal, " Old Rd"))
    idle = cu.filter(c % 10 == 0).select(*_user_columns(c, nk, bal, " Idle Ln", "new-"))
    return current.unionByName(older).unionByName(idle)


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 to 3 cards per customer (``c_custkey % 4`` of them), numbered k = 0, 1, 2."""
    cu = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    cards = cu.filter(c % 4 > 0).select(
        "c_custkey", F.explode(F.sequence(F.lit(0).cast("long"), c % 4 - 1)).alias("k")
    )
    k = F.col("k")
    return cards.select(
        _s(c * 3 + k).alias("id"),
        _s(c).alias("client_id"),
        F.when(k == 0, F.lit("Visa")).when(k == 1, F.lit("Mastercard")).otherwise(F.lit("Amex"))
        .alias("card_brand"),
        F.when(c % 3 == 0, F.lit("Debit")).when(c % 3 == 1, F.lit("Credit"))
        .otherwise(F.lit("Debit (Prepaid)")).alias("card_type"),
        F.when(c % 29 == 0, _s(c % 100))
        .otherwise(F.concat(F.lit("4000"), F.lpad(_s(c * 7919 + k * 13), 12, "0"))).alias("card_number"),
        F.concat(F.lpad(_s(c % 12 + 1), 2, "0"), F.lit("/"), _s(k + 2025)).alias("expires"),
        F.lpad(_s(c * 31 % 1000), 3, "0").alias("cvv"),
        F.when(c % 5 == 0, F.lit("NO")).otherwise(F.lit("YES")).alias("has_chip"),
        _s(k + 1).alias("num_cards_issued"),
        F.when(c % 11 == 0, F.lit("unknown"))
        .otherwise(F.concat(F.lit("$"), _s(c * 10), F.lit(".50"))).alias("credit_limit"),
        F.when(c % 13 == 0, F.lit("09/2002"))
        .otherwise(F.concat(_s(c % 30 + 1990), F.lit("-"), F.lpad(_s(c % 12 + 1), 2, "0"), F.lit("-01")))
        .alias("acct_open_date"),
        _s(c % 15 + 2010).alias("year_pin_last_changed"),
        F.when(c % 41 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("card_on_dark_web"),
    )


def raw_mcc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code per part brand; the description holds the smallest part type and a comma."""
    pa = table(spark, sf_dir, "part")
    return (
        pa.groupBy("p_brand")
        .agg(F.min("p_type").alias("mcc_description"))
        .select(F.col("p_brand").alias("mcc_code"),
                F.concat("mcc_description", F.lit(", all kinds")).alias("mcc_description"))
    )


RAW_ENTITIES = {
    "transactions": raw_transactions,
    "fraud_labels": raw_fraud_labels,
    "users": raw_users,
    "cards": raw_cards,
    "mcc_codes": raw_mcc_codes,
}


def bronze(spark: SparkSession, sf_dir: str, entity: str, ingestion_date: str = RUN_DATE) -> DataFrame:
    """A raw entity with bronze lineage, without a landing file in between."""
    raw = RAW_ENTITIES[entity](spark, sf_dir)
    return add_bronze_lineage(raw, entity, ingestion_date, source_file=f"testbed:{entity}")


def bronze_all(spark: SparkSession, sf_dir: str, ingestion_date: str = RUN_DATE) -> dict[str, DataFrame]:
    return {e: bronze(spark, sf_dir, e, ingestion_date) for e in RAW_ENTITIES}
