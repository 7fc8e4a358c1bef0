"""Registered queries: one per operator, each over the whole testbed tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame in its
*checked* form: surrogate keys and load timestamps (not reproducible) are
dropped and the quality-flag array is rendered as comma-joined text, so that
DuckDB's answer can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.functions import cleaning as C
from cardmarts.functions.metrics import rate_pct, risk_tier
from cardmarts.operators.aggregates import fraud_totals
from cardmarts.operators.dedup import keep_latest
from cardmarts.operators.distinct import count_merged, group_bitmaps, number_values
from cardmarts.operators.labels import MAX_HOT_IDS, frequent_ids
from cardmarts.plans import gold as G
from cardmarts.plans import silver as S
from cardmarts.plans.run import Lake, build_silver_table, run_all, run_layer
from cardmarts.session import shared_dir
from cardmarts.sinks.runlog import merge_log, read_log
from cardmarts.sinks.tables import (
    Written,
    bucket_count,
    compact_table,
    create_catalog_views,
    create_schema,
    current_path,
    publish_table,
    read_stats,
    read_table,
    register_table,
    save_bucketed,
    top_n,
)
from cardmarts.sinks.tables import layer_inventory as inventory
from cardmarts.sources.landing import read_landing
from cardmarts.testbed import entities as E
from cardmarts.testbed.landing import JSON_FILE_GLOB, new_landing_root, write_landing

RUN_DATE = E.RUN_DATE
_UNCHECKED = ("customer_sk", "card_sk", "mcc_sk", "transaction_sk", "_silver_loaded_at",
              "_gold_loaded_at", "_ingested_at", "_source_file")


def checked(df: DataFrame) -> DataFrame:
    """Drop non-reproducible columns; quality flags become comma-joined text."""
    out = df.drop(*[c for c in _UNCHECKED if c in df.columns])
    if "_dq_flags" in out.columns:
        out = out.withColumn("dq_flags", F.array_join("_dq_flags", ",")).drop("_dq_flags")
    return out


# -- silver ------------------------------------------------------------------

class _Silver(dict):
    """Silver tables as lazy plans over the testbed bronze, each built when it is named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, table: str) -> DataFrame:
        builder, inputs = S.SILVER_TABLES[table]
        df = builder(*[E.bronze(self.spark, self.sf_dir, i) for i in inputs], RUN_DATE)
        self[table] = S.with_month_partition(df) if table in S.PARTITION_COLUMNS else df
        return self[table]


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Silver(spark, sf_dir)


def _silver(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checked(silver_tables(spark, sf_dir)[name])
    q.__name__ = f"silver_{name}"
    return q


def _gold(name: str) -> Callable[[SparkSession, str], DataFrame]:
    builder, inputs = G.GOLD_TABLES[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = silver_tables(spark, sf_dir)
        return checked(builder(*[s[i] for i in inputs], RUN_DATE))
    q.__name__ = f"gold_{name}"
    return q


# -- single operators --------------------------------------------------------

def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest per transaction id over the whole bronze transactions."""
    return checked(keep_latest(E.bronze(spark, sf_dir, "transactions"), "id")).drop(
        "_ingestion_date", "_batch_id")


def cards_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.cards_per_customer(silver_tables(spark, sf_dir)["dim_card"])


def clean_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = E.raw_users(spark, sf_dir)
    return u.select(
        "address", "per_capita_income", "yearly_income", "total_debt",
        C.clean_currency("per_capita_income").alias("per_capita_income_value"),
        C.clean_currency("yearly_income").alias("yearly_income_value"),
        C.clean_currency("total_debt").alias("total_debt_value"),
    )


def mask_card_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = E.raw_cards(spark, sf_dir)
    return c.select("id", C.mask_card_number("card_number").alias("card_number_masked"))


def card_last4(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = E.raw_cards(spark, sf_dir)
    return c.select("id", C.card_last4("card_number").alias("card_number_last4"))


def round_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = E.raw_users(spark, sf_dir)
    return u.select("address", C.round_coordinates("latitude").alias("latitude"),
                    C.round_coordinates("longitude").alias("longitude"))


def cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = E.raw_users(spark, sf_dir)
    return u.select("address", "birth_month", C.to_int("birth_month").alias("birth_month_value"),
                    C.to_int("credit_score").alias("credit_score_value"))


def cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = E.raw_cards(spark, sf_dir)
    return c.select("id", C.to_boolean("has_chip").alias("has_chip"),
                    C.to_boolean("card_on_dark_web").alias("card_on_dark_web"))


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = E.raw_transactions(spark, sf_dir)
    return t.select("id", "date", C.to_timestamp("date").alias("transaction_datetime"))


def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = E.raw_cards(spark, sf_dir)
    return c.select("id", "acct_open_date", C.to_date("acct_open_date").alias("acct_open_date_value"))


def txn_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = E.raw_transactions(spark, sf_dir)
    y, m = C.year_month(C.to_timestamp("date"))
    return t.select("id", y.alias("txn_year"), m.alias("txn_month"))


def error_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = E.raw_transactions(spark, sf_dir)
    return t.select("id", "errors", C.error_flag("errors").alias("has_error"))


def label_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = E.raw_fraud_labels(spark, sf_dir)
    return lb.select("transaction_id", C.label_to_boolean("is_fraud_label").alias("is_fraud"))


def risk_tier_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud rate and tier per customer_id straight from the fact (no dimensions)."""
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    t = fraud_totals(fact, ["customer_id"], with_fraud_amount=False)
    return t.select("customer_id", "fraud_rate_pct", risk_tier("fraud_rate_pct").alias("risk_tier"))


def fraud_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact half-up percentage of fraud rows per merchant (supplier)."""
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    g = fact.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("t"), F.count_if(F.col("is_fraud")).alias("f"))
    return g.select("merchant_id", rate_pct("f", "t").alias("fraud_rate_pct"))


def json_dict_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``from_json`` to a string map and ``explode`` it, over ``events.props``."""
    ev = E.table(spark, sf_dir, "events")
    return ev.select("event_id", F.explode(F.from_json("props", "map<string,string>"))
                     .alias("prop_key", "prop_value"))


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys of the fact: one per transaction, none shared between transactions."""
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    return fact.agg(
        F.count_distinct("transaction_sk").alias("distinct_keys"),
        F.count_distinct("transaction_id").alias("distinct_transactions"),
        F.count_distinct("transaction_id", "transaction_sk").alias("distinct_pairs"),
    )


def layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit values of every silver dim_card row and every gold state-mart row."""
    s = silver_tables(spark, sf_dir)
    g = G.build_fraud_summary_by_state(s["fact_transactions"], RUN_DATE)

    def audit(df: DataFrame, layer: str) -> DataFrame:
        return df.groupBy(F.col(f"_{layer}_load_date").alias("load_date"), F.col(f"_{layer}_table").alias("table_name"),
                          F.col(f"_{layer}_batch_id").alias("batch_id")).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(f"_{layer}_loaded_at").isNotNull()).alias("stamped_rows"))

    return audit(s["dim_card"], "silver").unionByName(audit(g, "gold"))


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags of every fact row, as comma-joined text."""
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    return fact.select("transaction_id", F.array_join("_dq_flags", ",").alias("dq_flags"))


# -- sources ------------------------------------------------------------------

NEXT_DATE = "2024-01-02"


def _landing(spark: SparkSession, sf_dir: str, *entities: str, compression: str = "none") -> str:
    root = new_landing_root(spark)
    for e in entities:
        write_landing(spark, sf_dir, root, e, RUN_DATE, compression=compression)
    return root


def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions written as CSV landing files, scanned back with the fixed schema."""
    root = _landing(spark, sf_dir, "transactions")
    return checked(read_landing(spark, root, "transactions", RUN_DATE, "csv"))


def bronze_json_dict_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels written as ``{"target": {...}}`` files, read in splits."""
    root = _landing(spark, sf_dir, "fraud_labels")
    return checked(read_landing(spark, root, "fraud_labels", RUN_DATE, "json", whole=False,
                                file_glob=JSON_FILE_GLOB))


def bronze_json_dict_nested_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same label files read whole and parsed with ``from_json``."""
    root = _landing(spark, sf_dir, "fraud_labels")
    return checked(read_landing(spark, root, "fraud_labels", RUN_DATE, "json", whole=True,
                                file_glob=JSON_FILE_GLOB))


def bronze_json_dict_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant codes written as one flat ``{code: description}`` file."""
    root = _landing(spark, sf_dir, "mcc_codes")
    return checked(read_landing(spark, root, "mcc_codes", RUN_DATE, "json", file_glob=JSON_FILE_GLOB))


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage values of every bronze row scanned from CSV landing files."""
    root = _landing(spark, sf_dir, "cards")
    b = read_landing(spark, root, "cards", RUN_DATE)
    return b.groupBy("_ingestion_date", "_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("_ingested_at").isNotNull()).alias("stamped_rows"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("csv_file_rows"),
    )


def landing_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two delivery dates of users; reading one date must not see the other."""
    root = _landing(spark, sf_dir, "users")
    later = E.raw_users(spark, sf_dir).filter(F.col("id").isNotNull())
    write_landing(spark, sf_dir, root, "users", NEXT_DATE, df=later)
    return checked(read_landing(spark, root, "users", RUN_DATE))


# -- sinks and runs ---------------------------------------------------------------

def _lake(spark: SparkSession) -> Lake:
    return Lake(shared_dir(spark, "cardmarts-testbed", f"lake-{uuid.uuid4().hex[:12]}"))


def write_read_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_card published as parquet and read back through its live-copy pointer."""
    lake = _lake(spark)
    root = lake.table_root("silver", "dim_card")
    publish_table(spark, silver_tables(spark, sf_dir)["dim_card"], root)
    return checked(read_table(spark, root))


def _published_fact(spark: SparkSession, sf_dir: str, rebalance: bool | None = None) -> tuple[str, Written]:
    lake = _lake(spark)
    root = lake.table_root("silver", "fact_transactions")
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    return root, publish_table(spark, fact, root, partition_by=S.PARTITION_COLUMNS["fact_transactions"], rebalance=rebalance)


def fact_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month-partitioned fact read back with a year filter (pruned to that year's folders)."""
    root, _ = _published_fact(spark, sf_dir)
    return checked(read_table(spark, root).filter(F.col("txn_year") == 1997))


def compact_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned fact, written as the tasks come, compacted into a new version; the rows must not change."""
    root, _ = _published_fact(spark, sf_dir, rebalance=False)
    compact_table(spark, root, partition_by=S.PARTITION_COLUMNS["fact_transactions"])
    return checked(read_table(spark, root))


def row_count_from_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fact as observed during its write (no second count job)."""
    _, w = _published_fact(spark, sf_dir)
    return spark.createDataFrame([("fact_transactions", w.rows)], "table_name string, row_count long")


def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze layer ingested from landing files for all five entities, then counted."""
    lake = _lake(spark)
    root = _landing(spark, sf_dir, *E.RAW_ENTITIES)
    written = run_layer(spark, lake, "bronze", RUN_DATE, landing_root=root, log=False,
                        file_glob=JSON_FILE_GLOB)
    return inventory(spark, {t: lake.table_root("bronze", t) for t in written})


def _schema(spark: SparkSession) -> str:
    """A catalog schema of this run's own."""
    name = f"cardmarts_{uuid.uuid4().hex[:12]}"
    create_schema(spark, name, shared_dir(spark, "cardmarts-testbed", f"{name}.db"))
    return name


def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month-partitioned fact registered, moved to a second version, and read by its name."""
    root, first = _published_fact(spark, sf_dir, rebalance=False)  # the second version has the joined files
    name = f"{_schema(spark)}.fact_transactions"
    register_table(spark, name, first.path)
    second = compact_table(spark, root, partition_by=S.PARTITION_COLUMNS["fact_transactions"], whole=True)
    register_table(spark, name, second.path)
    return checked(spark.table(name))


def serving_view_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly trends published, registered, served by a catalog view, and the 10 busiest months taken."""
    lake = _lake(spark)
    s = silver_tables(spark, sf_dir)
    root = lake.table_root("gold", "monthly_transaction_trends")
    publish_table(spark, G.build_monthly_transaction_trends(s["fact_transactions"], RUN_DATE), root)
    schema = _schema(spark)
    register_table(spark, f"{schema}.trends", current_path(spark, root))
    (view,) = create_catalog_views(spark, {"trends": f"{schema}.trends"}, schema)
    return checked(top_n(spark.table(view), 10, F.desc("total_transactions"), F.asc_nulls_last("txn_year"),
                         F.asc_nulls_last("txn_month")))


def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of one logged silver build: STARTED with 0 rows, then SUCCESS with the count."""
    lake = _lake(spark)
    root = _landing(spark, sf_dir, "mcc_codes")
    run_layer(spark, lake, "bronze", RUN_DATE, landing_root=root, tables=["mcc_codes"], log=False,
              file_glob=JSON_FILE_GLOB)
    build_silver_table(spark, lake, "dim_mcc", RUN_DATE)
    return read_log(spark, lake.log_path).select(
        "pipeline_layer", "table_name", "step_name", "status", "row_count", "job_name", "load_type",
        "error_message")


def run_log_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log after its rows were merged into a segment."""
    lake = _lake(spark)
    root = _landing(spark, sf_dir, "mcc_codes")
    run_layer(spark, lake, "bronze", RUN_DATE, landing_root=root, tables=["mcc_codes"], log=False, file_glob=JSON_FILE_GLOB)
    build_silver_table(spark, lake, "dim_mcc", RUN_DATE)
    merge_log(spark, lake.log_path, least=1, grace_s=0)
    return read_log(spark, lake.log_path).select(
        "pipeline_layer", "table_name", "step_name", "status", "row_count", "job_name", "load_type", "error_message")


def fact_clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month-partitioned fact written in ranges of customer and merchant, and read back."""
    root = _lake(spark).table_root("silver", "fact_transactions")
    publish_table(spark, silver_tables(spark, sf_dir)["fact_transactions"], root, partition_by=S.PARTITION_COLUMNS["fact_transactions"],
                  cluster_by=["customer_id", "merchant_id"])
    return checked(read_table(spark, root))


def frequent_mcc_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant codes of more than one row in 5,000, from the summary observed while bronze transactions are written."""
    root = _lake(spark).table_root("bronze", "transactions")
    w = publish_table(spark, E.bronze(spark, sf_dir, "transactions"), root, measures={"mcc": frequent_ids("mcc")})
    found = read_stats(spark, w.path)
    rows = [(item, count) for item, count in found["mcc"] if item is not None and count * MAX_HOT_IDS > found["rows"]]
    return spark.createDataFrame(rows, "mcc string, row_count long")


def distinct_customers_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per year, merged from the months' bitmaps over dense customer numbers."""
    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    numbers = number_values(fact, "customer_id")
    months = group_bitmaps(fact, ["txn_year", "txn_month"], "customer_id", numbers)
    return count_merged(months, ["txn_year"], "unique_customers")


def bucketed_risk_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk profile from silver tables bucketed on customer_id; the buckets grow in number with the input."""
    silver, schema = silver_tables(spark, sf_dir), _schema(spark)
    names, tables = G.GOLD_TABLES["customer_risk_profile"][1], {}
    buckets = bucket_count([silver[name] for name in names])
    for name in names:
        path = shared_dir(spark, "cardmarts-testbed", f"{schema}-{name}")
        save_bucketed(silver[name], f"{schema}.{name}", "customer_id", buckets, path)
        tables[name] = spark.table(f"{schema}.{name}")
    return checked(G.build_customer_risk_profile(*tables.values(), RUN_DATE))


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from landing files: bronze, silver, gold; the risk profile read back."""
    lake = _lake(spark)
    root = _landing(spark, sf_dir, *E.RAW_ENTITIES, compression="gzip")
    run_all(spark, lake, root, RUN_DATE, file_glob=JSON_FILE_GLOB)
    return checked(lake.read(spark, "gold", "customer_risk_profile"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"silver_{n}": _silver(n) for n in S.SILVER_TABLES},
    **{f"gold_{n}": _gold(n) for n in G.GOLD_TABLES},
    "dedup_latest": dedup_latest,
    "cards_per_customer": cards_per_customer,
    "clean_currency": clean_currency,
    "mask_card_number": mask_card_number,
    "card_last4": card_last4,
    "round_coordinates": round_coordinates,
    "cast_int": cast_int,
    "cast_boolean": cast_boolean,
    "parse_timestamp": parse_timestamp,
    "parse_date": parse_date,
    "txn_year_month": txn_year_month,
    "error_flag": error_flag,
    "label_to_boolean": label_to_boolean,
    "risk_tier": risk_tier_by_customer,
    "fraud_rate": fraud_rate,
    "json_dict_explode": json_dict_explode,
    "surrogate_key": surrogate_key,
    "dq_flags": dq_flags,
    "layer_audit": layer_audit,
    "bronze_lineage": bronze_lineage,
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_json_dict_nested": bronze_json_dict_nested,
    "bronze_json_dict_nested_whole": bronze_json_dict_nested_whole,
    "bronze_json_dict_flat": bronze_json_dict_flat,
    "landing_partition_scan": landing_partition_scan,
    "write_read_roundtrip": write_read_roundtrip,
    "fact_partition_prune": fact_partition_prune,
    "compact_table": compact_fact,
    "row_count_from_write": row_count_from_write,
    "registered_table": registered_table,
    "layer_inventory": layer_inventory,
    "serving_view_top_n": serving_view_top_n,
    "run_log_append": run_log_append,
    "run_log_merged": run_log_merged,
    "fact_clustered_write": fact_clustered_write,
    "frequent_mcc_observed": frequent_mcc_observed,
    "distinct_customers_merged": distinct_customers_merged,
    "bucketed_risk_profile": bucketed_risk_profile,
    "pipeline_end_to_end": pipeline_end_to_end,
}
