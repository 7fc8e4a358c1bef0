"""Independent DuckDB SQL for every registered query.

The raw entities repeat the testbed rules of ``entities.py`` in SQL; each
operator is then written from its specification, not from the Spark code:
dedup as ``ROW_NUMBER``, casts spelled out where DuckDB's own casts differ
from Spark's (``'1e3'`` or ``'-3.7'`` to int, ``'yes'`` to boolean),
rounding half up with integer arithmetic, quality flags as ``concat_ws``.
"""

from __future__ import annotations

RUN_DATE = "2024-01-01"

# -- raw entities ------------------------------------------------------------

RAW = {
    "raw_transactions": """
SELECT
  cast(l.l_orderkey AS varchar) || '-' || cast(l.l_linenumber AS varchar) AS id,
  CASE WHEN l.l_orderkey % 251 = 0 THEN 'unknown' ELSE cast(o.o_orderdate AS varchar) END AS date,
  cast(o.o_custkey AS varchar) AS client_id,
  cast(o.o_custkey * 3 + l.l_linenumber % 3 AS varchar) AS card_id,
  CASE WHEN l.l_partkey % 37 = 0 THEN ''
       WHEN l.l_orderkey % 499 = 0 AND l.l_linenumber = 1 THEN '$1e30'
       WHEN l.l_partkey % 41 = 0 THEN '$' || cast(cast(l.l_extendedprice AS decimal(18,2)) AS varchar) || '5'
       ELSE '$' || cast(cast(l.l_extendedprice AS decimal(18,2)) AS varchar) END AS amount,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'Chip Transaction' WHEN 1 THEN 'Swipe Transaction'
       ELSE 'Online Transaction' END AS use_chip,
  cast(l.l_suppkey AS varchar) AS merchant_id,
  s.s_name AS merchant_city,
  n.n_name AS merchant_state,
  CASE WHEN l.l_linenumber % 3 = 2 THEN NULL ELSE cast(l.l_suppkey + 10000 AS varchar) END AS zip,
  CASE WHEN l.l_partkey % 53 = 0 THEN 'Brand#00' ELSE p.p_brand END AS mcc,
  CASE WHEN l.l_linestatus = 'F' AND l.l_linenumber = 1 THEN 'Bad PIN' END AS errors
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey""",
    "raw_fraud_labels": """
SELECT transaction_id, is_fraud_label FROM (
  SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS transaction_id,
         CASE WHEN max(l_returnflag) = 'R' AND l_orderkey % 20 = 0 THEN 'Yes'
              WHEN max(l_returnflag) <> 'A' THEN 'No' END AS is_fraud_label
  FROM lineitem GROUP BY l_orderkey, l_linenumber) g
WHERE is_fraud_label IS NOT NULL""",
    "raw_users": """
SELECT
  CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE pre || cast(c_custkey AS varchar) END AS id,
  cast(c_custkey % 60 + 20 AS varchar) AS current_age,
  cast(c_custkey % 10 + 60 AS varchar) AS retirement_age,
  cast(2004 - c_custkey % 60 AS varchar) AS birth_year,
  CASE WHEN c_custkey % 5 = 0 THEN cast(c_custkey % 12 + 1 AS varchar) || '.0'
       ELSE cast(c_custkey % 12 + 1 AS varchar) END AS birth_month,
  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  cast(c_custkey AS varchar) || sfx AS address,
  '-' || cast(c_nationkey + 30 AS varchar) || '.12' || cast(c_custkey % 10 AS varchar) AS latitude,
  cast(c_custkey % 50 + 70 AS varchar) || '.' || lpad(cast(c_custkey % 1000 AS varchar), 3, '0') AS longitude,
  '$' || cast(cast(c_acctbal AS decimal(18,2)) AS varchar) AS per_capita_income,
  CASE WHEN c_custkey % 23 = 0 THEN 'n/a'
       ELSE '$' || cast(cast(cast(c_acctbal AS decimal(18,2)) * 12 AS decimal(18,2)) AS varchar) END
    AS yearly_income,
  '$' || cast(c_custkey % 50 AS varchar) || ',' || lpad(cast(c_custkey * 7 % 1000 AS varchar), 3, '0')
      || '.' || lpad(cast(c_custkey % 100 AS varchar), 2, '0') AS total_debt,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE cast(c_custkey % 350 + 500 AS varchar) END AS credit_score,
  cast(c_custkey % 4 AS varchar) AS num_credit_cards
FROM (SELECT *, ' Main St' AS sfx, '' AS pre FROM customer
      UNION ALL
      SELECT *, ' Old Rd' AS sfx, '' AS pre FROM customer WHERE c_custkey % 7 = 0
      UNION ALL
      SELECT *, ' Idle Ln' AS sfx, 'new-' AS pre FROM customer WHERE c_custkey % 10 = 0) cu""",
    "raw_cards": """
SELECT
  cast(c_custkey * 3 + k AS varchar) AS id,
  cast(c_custkey AS varchar) AS client_id,
  CASE k WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Amex' END AS card_brand,
  CASE c_custkey % 3 WHEN 0 THEN 'Debit' WHEN 1 THEN 'Credit' ELSE 'Debit (Prepaid)' END AS card_type,
  CASE WHEN c_custkey % 29 = 0 THEN cast(c_custkey % 100 AS varchar)
       ELSE '4000' || lpad(cast(c_custkey * 7919 + k * 13 AS varchar), 12, '0') END AS card_number,
  lpad(cast(c_custkey % 12 + 1 AS varchar), 2, '0') || '/' || cast(k + 2025 AS varchar) AS expires,
  lpad(cast(c_custkey * 31 % 1000 AS varchar), 3, '0') AS cvv,
  CASE WHEN c_custkey % 5 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
  cast(k + 1 AS varchar) AS num_cards_issued,
  CASE WHEN c_custkey % 11 = 0 THEN 'unknown' ELSE '$' || cast(c_custkey * 10 AS varchar) || '.50' END
    AS credit_limit,
  CASE WHEN c_custkey % 13 = 0 THEN '09/2002'
       ELSE cast(c_custkey % 30 + 1990 AS varchar) || '-' || lpad(cast(c_custkey % 12 + 1 AS varchar), 2, '0')
            || '-01' END AS acct_open_date,
  cast(c_custkey % 15 + 2010 AS varchar) AS year_pin_last_changed,
  CASE WHEN c_custkey % 41 = 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web
FROM (SELECT c_custkey, unnest(range(0, c_custkey % 4)) AS k FROM customer) cc""",
    "raw_mcc_codes": """
SELECT p_brand AS mcc_code, min(p_type) || ', all kinds' AS mcc_description
FROM part GROUP BY p_brand""",
}

ENTITY_COLUMNS = {
    "transactions": ["id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id",
                     "merchant_city", "merchant_state", "zip", "mcc", "errors"],
    "users": ["id", "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address",
              "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt",
              "credit_score", "num_credit_cards"],
    "cards": ["id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv", "has_chip",
              "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed",
              "card_on_dark_web"],
    "mcc_codes": ["mcc_code", "mcc_description"],
    "fraud_labels": ["transaction_id", "is_fraud_label"],
}


def _latest(entity: str, key: str) -> str:
    """Keep-latest: all bronze rows of a batch tie on the ingest time, so the
    entity columns after the key decide, descending with nulls last."""
    cols = [c for c in ENTITY_COLUMNS[entity] if c != key]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in cols)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM raw_{entity}) t WHERE rn = 1")


def _int(c: str) -> str:
    # Spark's lenient rule: optional sign, digits, optional fraction that is dropped.
    return (f"CASE WHEN regexp_matches(trim({c}), '^[+-]?[0-9]+(\\.[0-9]*)?$') "
            f"THEN try_cast(regexp_replace(trim({c}), '\\.[0-9]*$', '') AS integer) END")


def _money(c: str) -> str:
    return f"try_cast(regexp_replace({c}, '[$,]', '', 'g') AS double)"


def _bool(c: str) -> str:
    return (f"CASE WHEN lower(trim({c})) IN ('t', 'true', 'y', 'yes', '1') THEN true "
            f"WHEN lower(trim({c})) IN ('f', 'false', 'n', 'no', '0') THEN false END")


def _round2(c: str) -> str:
    return f"cast(round(cast(try_cast({c} AS double) AS decimal(18,6)), 2) AS double)"


def _flags(*rules: tuple[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN {c} IS NULL THEN '{name}' END" for c, name in rules)
    return f"concat_ws(',', {parts})"


def _audit(layer: str, table: str) -> str:
    return (f"'{RUN_DATE}' AS _{layer}_load_date, '{table}' AS _{layer}_table, "
            f"'{table}_{RUN_DATE}' AS _{layer}_batch_id")


def _rate(f: str, t: str) -> str:
    return f"cast(({f} * 20000 + {t}) // (2 * {t}) AS double) / 100"


SILVER = {
    "dim_customer": f"""
SELECT id AS customer_id,
  {_int('current_age')} AS current_age, {_int('retirement_age')} AS retirement_age,
  {_int('birth_year')} AS birth_year, {_int('birth_month')} AS birth_month,
  gender, address, {_round2('latitude')} AS latitude, {_round2('longitude')} AS longitude,
  {_money('per_capita_income')} AS per_capita_income, {_money('yearly_income')} AS yearly_income,
  {_money('total_debt')} AS total_debt, {_int('credit_score')} AS credit_score,
  {_int('num_credit_cards')} AS num_credit_cards,
  'users_{RUN_DATE}' AS _bronze_batch_id
FROM latest_users""",
    "dim_card": f"""
SELECT id AS card_id, client_id AS customer_id, card_brand, card_type,
  CASE WHEN card_number IS NOT NULL THEN '************' || right(card_number, 4) END AS card_number_masked,
  right(card_number, 4) AS card_number_last4,
  {_bool('has_chip')} AS has_chip, {_bool('card_on_dark_web')} AS card_on_dark_web,
  {_int('num_cards_issued')} AS num_cards_issued, {_money('credit_limit')} AS credit_limit,
  try_cast(acct_open_date AS date) AS acct_open_date,
  {_int('year_pin_last_changed')} AS year_pin_last_changed, expires,
  'cards_{RUN_DATE}' AS _bronze_batch_id
FROM latest_cards""",
    "dim_mcc": f"""
SELECT mcc_code, mcc_description, 'mcc_codes_{RUN_DATE}' AS _bronze_batch_id FROM latest_mcc_codes""",
    "fact_transactions": f"""
SELECT t.id AS transaction_id,
  try_cast(t.date AS timestamp) AS transaction_datetime,
  t.client_id AS customer_id, t.card_id, {_money('t.amount')} AS amount, t.use_chip AS channel,
  t.merchant_id, t.merchant_city, t.merchant_state, t.zip, t.mcc AS mcc_code,
  t.errors IS NOT NULL AS has_error, t.errors AS error_detail,
  'transactions_{RUN_DATE}' AS _bronze_batch_id_transactions,
  CASE lb.is_fraud_label WHEN 'Yes' THEN true WHEN 'No' THEN false END AS is_fraud,
  CASE WHEN lb.transaction_id IS NOT NULL THEN 'fraud_labels_{RUN_DATE}' END AS _bronze_batch_id_fraud_labels
FROM latest_transactions t LEFT JOIN raw_fraud_labels lb ON t.id = lb.transaction_id""",
}


def _with(*names: str) -> str:
    """WITH clause holding the raw entities, the latest rows and the silver tables named."""
    ctes = [f"{k} AS ({v})" for k, v in RAW.items()]
    ctes += [
        f"latest_users AS ({_latest('users', 'id')})",
        f"latest_cards AS ({_latest('cards', 'id')})",
        f"latest_mcc_codes AS ({_latest('mcc_codes', 'mcc_code')})",
        f"latest_transactions AS ({_latest('transactions', 'id')})",
    ]
    for n in names:
        body = SILVER[n]
        if n == "fact_transactions":
            body = (f"SELECT *, cast(year(transaction_datetime) AS integer) AS txn_year, "
                    f"cast(month(transaction_datetime) AS integer) AS txn_month FROM ({body}) f")
        ctes.append(f"silver_{n} AS ({body})")
    return "WITH " + ",\n".join(ctes) + "\n"


AMOUNT = "try_cast(amount AS decimal(30,6))"  # what can be summed exactly
FACT_FLAGS = _flags((AMOUNT, "invalid_amount"), ("transaction_datetime", "invalid_datetime"),
                    ("customer_id", "missing_customer_id"))
CUSTOMER_FLAGS = _flags(("customer_id", "missing_customer_id"), ("yearly_income", "invalid_yearly_income"),
                        ("credit_score", "missing_credit_score"))
CARD_FLAGS = _flags(("card_id", "missing_card_id"), ("credit_limit", "invalid_credit_limit"))


def _totals(keys: str, amount_name: str = "total_amount", fraud_amount: bool = True, extra: str = "") -> str:
    fa = (",\n  cast(sum(CASE WHEN is_fraud THEN try_cast(amount AS decimal(30,6)) ELSE 0 END) AS double)"
          " AS total_fraud_amount") if fraud_amount else ""
    return f"""SELECT {keys}, total_transactions, total_fraud_transactions, {amount_name}
  {', total_fraud_amount' if fraud_amount else ''}{extra and ', ' + extra},
  {_rate('total_fraud_transactions', 'total_transactions')} AS fraud_rate_pct
FROM (SELECT {keys}, count(*) AS total_transactions,
  count(*) FILTER (WHERE is_fraud) AS total_fraud_transactions,
  cast(sum({AMOUNT}) AS double) AS {amount_name}{fa}
  {extra and ', ' + _EXTRA[extra]}
  FROM silver_fact_transactions GROUP BY {keys}) g"""


# the mean's rounding: whole hundredths of the sum in millionths, half away from zero
_MILLIONTHS = f"cast(sum({AMOUNT}) * 1000000 AS hugeint)"
_EXTRA = {
    "avg_transaction_amount, unique_customers": f"""
  CASE WHEN count({AMOUNT}) > 0 THEN cast(sign({_MILLIONTHS}) * (
    (2 * abs({_MILLIONTHS}) + 10000 * cast(count({AMOUNT}) AS hugeint))
    // (20000 * cast(count({AMOUNT}) AS hugeint))) AS double) / 100 END AS avg_transaction_amount,
  count(DISTINCT customer_id) AS unique_customers""",
}


def _tier(c: str) -> str:
    return f"CASE WHEN {c} = 0 THEN 'Low' WHEN {c} <= 5 THEN 'Medium' ELSE 'High' END"


GOLD = {
    "fraud_summary_by_state": _totals("merchant_state"),
    "fraud_summary_by_mcc": f"""
SELECT g.*, m.mcc_description FROM ({_totals('mcc_code')}) g
LEFT JOIN silver_dim_mcc m ON g.mcc_code = m.mcc_code""",
    "monthly_transaction_trends": _totals(
        "txn_year, txn_month", fraud_amount=False, extra="avg_transaction_amount, unique_customers"),
    "customer_risk_profile": f"""
SELECT c.customer_id, c.current_age, c.credit_score, c.yearly_income,
  t.total_transactions, t.total_fraud_transactions, t.total_spend, t.fraud_rate_pct,
  k.num_cards, {_tier('t.fraud_rate_pct')} AS risk_tier
FROM silver_dim_customer c
LEFT JOIN ({_totals('customer_id', amount_name='total_spend', fraud_amount=False)}) t
  ON c.customer_id = t.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS num_cards FROM silver_dim_card GROUP BY customer_id) k
  ON c.customer_id = k.customer_id""",
}

GOLD_INPUTS = {
    "fraud_summary_by_state": ("fact_transactions",),
    "fraud_summary_by_mcc": ("fact_transactions", "dim_mcc"),
    "monthly_transaction_trends": ("fact_transactions",),
    "customer_risk_profile": ("fact_transactions", "dim_customer", "dim_card"),
}

SILVER_FLAGS = {"dim_customer": CUSTOMER_FLAGS, "dim_card": CARD_FLAGS, "fact_transactions": FACT_FLAGS}


def silver_sql(name: str) -> str:
    """Checked form of a silver table: no surrogate key or load time, flags as text."""
    flags = f", {SILVER_FLAGS[name]} AS dq_flags" if name in SILVER_FLAGS else ""
    return _with(name) + f"SELECT *{flags}, {_audit('silver', name)} FROM silver_{name}"


def gold_sql(name: str) -> str:
    """Checked form of a gold mart: no surrogate key or load time."""
    return _with(*GOLD_INPUTS[name]) + f"SELECT *, {_audit('gold', name)} FROM ({GOLD[name]}) x"


def _raw(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({RAW[n]})" for n in names) + "\n"


def _fact_totals_by(key: str) -> str:
    return _with("fact_transactions") + f"""SELECT {key}, count(*) AS t,
  count(*) FILTER (WHERE is_fraud) AS f FROM silver_fact_transactions GROUP BY {key}"""


def oracle_sql() -> dict[str, str]:
    """Query key -> DuckDB SQL over the pre-registered source tables."""
    out: dict[str, str] = {}
    for n in SILVER:
        out[f"silver_{n}"] = silver_sql(n)
    for n in GOLD:
        out[f"gold_{n}"] = gold_sql(n)
    out["dedup_latest"] = _with() + "SELECT * FROM latest_transactions"
    out["cards_per_customer"] = _with("dim_card") + (
        "SELECT customer_id, count(*) AS num_cards FROM silver_dim_card GROUP BY customer_id")
    out["clean_currency"] = _raw("raw_users") + f"""SELECT address, per_capita_income, yearly_income,
  total_debt, {_money('per_capita_income')} AS per_capita_income_value,
  {_money('yearly_income')} AS yearly_income_value, {_money('total_debt')} AS total_debt_value
FROM raw_users"""
    out["mask_card_number"] = _raw("raw_cards") + """SELECT id,
  CASE WHEN card_number IS NOT NULL THEN '************' || right(card_number, 4) END
    AS card_number_masked FROM raw_cards"""
    out["card_last4"] = _raw("raw_cards") + "SELECT id, right(card_number, 4) AS card_number_last4 FROM raw_cards"
    out["round_coordinates"] = _raw("raw_users") + (
        f"SELECT address, {_round2('latitude')} AS latitude, {_round2('longitude')} AS longitude FROM raw_users")
    out["cast_int"] = _raw("raw_users") + (
        f"SELECT address, birth_month, {_int('birth_month')} AS birth_month_value, "
        f"{_int('credit_score')} AS credit_score_value FROM raw_users")
    out["cast_boolean"] = _raw("raw_cards") + (
        f"SELECT id, {_bool('has_chip')} AS has_chip, {_bool('card_on_dark_web')} AS card_on_dark_web "
        f"FROM raw_cards")
    out["parse_timestamp"] = _raw("raw_transactions") + (
        "SELECT id, date, try_cast(date AS timestamp) AS transaction_datetime FROM raw_transactions")
    out["parse_date"] = _raw("raw_cards") + (
        "SELECT id, acct_open_date, try_cast(acct_open_date AS date) AS acct_open_date_value FROM raw_cards")
    out["txn_year_month"] = _raw("raw_transactions") + (
        "SELECT id, cast(year(try_cast(date AS timestamp)) AS integer) AS txn_year, "
        "cast(month(try_cast(date AS timestamp)) AS integer) AS txn_month FROM raw_transactions")
    out["error_flag"] = _raw("raw_transactions") + (
        "SELECT id, errors, errors IS NOT NULL AS has_error FROM raw_transactions")
    out["label_to_boolean"] = _raw("raw_fraud_labels") + (
        "SELECT transaction_id, CASE is_fraud_label WHEN 'Yes' THEN true WHEN 'No' THEN false END "
        "AS is_fraud FROM raw_fraud_labels")
    out["risk_tier"] = f"""SELECT customer_id, {_rate('f', 't')} AS fraud_rate_pct,
  {_tier(_rate('f', 't'))} AS risk_tier FROM ({_fact_totals_by('customer_id')}) g"""
    out["fraud_rate"] = f"""SELECT merchant_id, {_rate('f', 't')} AS fraud_rate_pct
FROM ({_fact_totals_by('merchant_id')}) g"""
    out["json_dict_explode"] = """SELECT event_id, k AS prop_key, props ->> k AS prop_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) e"""
    out["surrogate_key"] = _with("fact_transactions") + (
        "SELECT count(DISTINCT transaction_id) AS distinct_keys, count(DISTINCT transaction_id) "
        "AS distinct_transactions, count(DISTINCT transaction_id) AS distinct_pairs "
        "FROM silver_fact_transactions")
    out["dq_flags"] = _with("fact_transactions") + (
        f"SELECT transaction_id, {FACT_FLAGS} AS dq_flags FROM silver_fact_transactions")
    out["layer_audit"] = _with("dim_card", "fact_transactions") + f"""
SELECT '{RUN_DATE}' AS load_date, 'dim_card' AS table_name, 'dim_card_{RUN_DATE}' AS batch_id,
  count(*) AS row_count, count(*) AS stamped_rows FROM silver_dim_card
UNION ALL
SELECT '{RUN_DATE}', 'fraud_summary_by_state', 'fraud_summary_by_state_{RUN_DATE}',
  count(DISTINCT merchant_state) + max(CASE WHEN merchant_state IS NULL THEN 1 ELSE 0 END),
  count(DISTINCT merchant_state) + max(CASE WHEN merchant_state IS NULL THEN 1 ELSE 0 END)
FROM silver_fact_transactions"""
    out["bronze_lineage"] = _raw("raw_cards") + f"""SELECT '{RUN_DATE}' AS _ingestion_date,
  'cards_{RUN_DATE}' AS _batch_id, count(*) AS row_count, count(*) AS stamped_rows,
  count(*) AS csv_file_rows FROM raw_cards"""
    out.update(source_and_sink_sql())
    return out


def _bronze_consts(entity: str) -> str:
    return f"'{RUN_DATE}' AS _ingestion_date, '{entity}_{RUN_DATE}' AS _batch_id"


def source_and_sink_sql() -> dict[str, str]:
    """Oracles for the source, sink and end-to-end queries."""
    out: dict[str, str] = {}
    # CSV has no empty-versus-null distinction: an empty field scans as null
    csv_cols = ", ".join(f"nullif({c}, '') AS {c}" for c in ENTITY_COLUMNS["transactions"])
    out["bronze_csv_scan"] = _raw("raw_transactions") + (
        f"SELECT {csv_cols}, {_bronze_consts('transactions')} FROM raw_transactions")
    for key in ("bronze_json_dict_nested", "bronze_json_dict_nested_whole"):
        out[key] = _raw("raw_fraud_labels") + (
            f"SELECT *, {_bronze_consts('fraud_labels')} FROM raw_fraud_labels")
    out["bronze_json_dict_flat"] = _raw("raw_mcc_codes") + (
        f"SELECT *, {_bronze_consts('mcc_codes')} FROM raw_mcc_codes")
    out["landing_partition_scan"] = _raw("raw_users") + f"SELECT *, {_bronze_consts('users')} FROM raw_users"
    out["write_read_roundtrip"] = silver_sql("dim_card")
    out["fact_partition_prune"] = f"SELECT * FROM ({silver_sql('fact_transactions')}) f WHERE txn_year = 1997"
    out["compact_table"] = silver_sql("fact_transactions")
    out["registered_table"] = silver_sql("fact_transactions")
    out["row_count_from_write"] = _with("fact_transactions") + (
        "SELECT 'fact_transactions' AS table_name, count(*) AS row_count FROM silver_fact_transactions")
    out["layer_inventory"] = _raw(*RAW) + "\nUNION ALL\n".join(
        f"SELECT '{n[4:]}' AS table_name, count(*) AS row_count FROM {n}" for n in RAW)
    out["serving_view_top_n"] = (
        f"SELECT * FROM ({gold_sql('monthly_transaction_trends')}) g "
        "ORDER BY total_transactions DESC, txn_year ASC NULLS LAST, txn_month ASC NULLS LAST LIMIT 10")
    out["run_log_append"] = _with() + """SELECT 'silver' AS pipeline_layer, 'dim_mcc' AS table_name,
  'build silver.dim_mcc' AS step_name, s.status, CASE s.status WHEN 'STARTED' THEN 0 ELSE n.c END
  AS row_count, 'silver_build' AS job_name, 'overwrite' AS load_type, NULL::varchar AS error_message
FROM (VALUES ('STARTED'), ('SUCCESS')) s(status), (SELECT count(*) AS c FROM latest_mcc_codes) n"""
    out["run_log_merged"] = out["run_log_append"]
    out["fact_clustered_write"] = silver_sql("fact_transactions")
    out["frequent_mcc_observed"] = _raw("raw_transactions") + """SELECT mcc, count(*) AS row_count FROM raw_transactions
WHERE mcc IS NOT NULL GROUP BY mcc HAVING count(*) * 5000 > (SELECT count(*) FROM raw_transactions)"""
    out["distinct_customers_merged"] = _with("fact_transactions") + (
        "SELECT txn_year, count(DISTINCT customer_id) AS unique_customers FROM silver_fact_transactions WHERE customer_id IS NOT NULL GROUP BY txn_year")
    out["bucketed_risk_profile"] = gold_sql("customer_risk_profile")
    out["pipeline_end_to_end"] = gold_sql("customer_risk_profile")
    return out
