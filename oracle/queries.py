"""DuckDB oracle text per registered query (same keys as the Spark catalog)."""

from __future__ import annotations

from oracle.sql import bigint_sum, query, safe_pct, sround

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: str) -> None:
    if name in ORACLE:
        raise ValueError(f"duplicate oracle {name}")
    ORACLE[name] = query(body, *ctes)


FRAUD_AMT = sround("SUM(CASE WHEN is_fraud = 1 THEN amount ELSE 0.0 END)", 2)
TOTAL = sround("SUM(amount)", 2)
AVG = sround("AVG(amount)", 2)
MIN = sround("MIN(amount)", 2)
MAX = sround("MAX(amount)", 2)

# ------------------------------------------------------------------ ingest
oracle("raw_transactions", "SELECT * FROM raw", "raw")
oracle("bronze_rename", """
SELECT step, transaction_type, amount, origin_account, origin_old_balance, origin_new_balance,
       destination_account, destination_old_balance, destination_new_balance, is_fraud, is_flagged_fraud
FROM bronze_m""", "bronze_m")
oracle("bronze_transactions", "SELECT * FROM bronze_m", "bronze_m")
oracle("record_hash", "SELECT step, type, amount, nameOrig, _record_hash FROM bronze_n", "bronze_n")

# ------------------------------------------------------------------ strict silver
oracle("select_valid", """
SELECT step, transaction_type, amount, origin_account, origin_old_balance, origin_new_balance,
       destination_account, destination_old_balance, destination_new_balance, is_fraud, is_flagged_fraud,
       source_file_name, pipeline_run_id
FROM silver_m""", "silver_m")
oracle("time_features", """
SELECT step, CAST(floor((step - 1) / 24.0) + 1 AS INTEGER) AS transaction_day,
       CAST((((step - 1) % 24) + 24) % 24 AS INTEGER) AS transaction_hour
FROM bronze_m""", "bronze_m")
oracle("balance_features", f"""
SELECT origin_account, amount,
  {sround('origin_old_balance - origin_new_balance', 2)} AS origin_balance_change,
  {sround('destination_new_balance - destination_old_balance', 2)} AS destination_balance_change,
  {sround('origin_old_balance - amount - origin_new_balance', 2)} AS origin_balance_error,
  {sround('destination_old_balance + amount - destination_new_balance', 2)} AS destination_balance_error
FROM bronze_m""", "bronze_m")
oracle("transaction_indicators", """
SELECT amount, origin_account, destination_account,
  CASE WHEN amount >= 200000.0 THEN 1 ELSE 0 END AS is_high_value_transaction,
  CASE WHEN amount = 0 THEN 1 ELSE 0 END AS is_zero_amount_transaction,
  CASE WHEN starts_with(origin_account, 'M') THEN 1 ELSE 0 END AS is_origin_merchant,
  CASE WHEN starts_with(destination_account, 'M') THEN 1 ELSE 0 END AS is_destination_merchant
FROM bronze_m""", "bronze_m")
oracle("silver_transactions", "SELECT * FROM silver_m", "silver_m")

# ------------------------------------------------------------------ strict gold
_DAILY_CORE = f"""
SELECT transaction_day, transaction_count, total_transaction_amount, average_transaction_amount,
  minimum_transaction_amount, maximum_transaction_amount, fraud_count, fraud_amount, flagged_fraud_count,
  high_value_transaction_count,
  {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct,
  {safe_pct('fraud_amount', 'total_transaction_amount')} AS fraud_amount_pct
FROM (
  SELECT transaction_day, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {AVG} AS average_transaction_amount, {MIN} AS minimum_transaction_amount, {MAX} AS maximum_transaction_amount,
    {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count
  FROM silver_m GROUP BY transaction_day
) g"""
oracle("daily_transaction_summary_core", _DAILY_CORE, "silver_m")

oracle("daily_type_summary", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT transaction_day, transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {AVG} AS average_transaction_amount, {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount
  FROM silver_m GROUP BY transaction_day, transaction_type) g""", "silver_m")

oracle("hourly_fraud_summary", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT step AS hourly_step, COUNT(*) AS transaction_count, {bigint_sum('is_fraud')} AS fraud_count,
    {TOTAL} AS total_transaction_amount, {FRAUD_AMT} AS fraud_amount
  FROM silver_m GROUP BY step) g""", "silver_m")

oracle("transaction_type_summary", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {AVG} AS average_transaction_amount, {bigint_sum('is_fraud')} AS fraud_count,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count
  FROM silver_m GROUP BY transaction_type) g""", "silver_m")

for _key, _prefix in (("origin_account", "origin"), ("destination_account", "destination")):
    oracle(f"{_prefix}_account_summary", f"""
SELECT {_key}, COUNT(*) AS {_prefix}_transaction_count, {TOTAL} AS {_prefix}_total_amount,
  {AVG} AS {_prefix}_average_amount, {bigint_sum('is_fraud')} AS {_prefix}_fraud_count,
  MAX(step) AS latest_{_prefix}_transaction_step
FROM silver_m GROUP BY {_key}""", "silver_m")

oracle("high_value_summary", f"""
SELECT transaction_day, transaction_type, COUNT(*) AS high_value_transaction_count,
  {TOTAL} AS high_value_total_amount, {AVG} AS high_value_average_amount,
  {bigint_sum('is_fraud')} AS high_value_fraud_count
FROM silver_m WHERE is_high_value_transaction = 1 GROUP BY transaction_day, transaction_type""", "silver_m")

oracle("fraud_monitoring", """
SELECT step, transaction_day, transaction_hour, transaction_type, amount, origin_account, destination_account,
  is_fraud, is_flagged_fraud, is_high_value_transaction, pipeline_run_id
FROM silver_m WHERE is_fraud = 1""", "silver_m")

_PRIOR = "OVER (PARTITION BY origin_account ORDER BY step, _record_hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
oracle("fraud_feature", f"""
SELECT step, transaction_day, transaction_hour, transaction_type, amount, origin_account, destination_account,
  is_high_value_transaction, is_destination_merchant,
  COUNT(*) {_PRIOR} AS prior_origin_transaction_count,
  {sround(f'AVG(amount) {_PRIOR}', 2)} AS prior_origin_average_amount,
  {sround(f'MAX(amount) {_PRIOR}', 2)} AS prior_origin_maximum_amount,
  is_fraud
FROM silver_mh""", "silver_mh")

oracle("exact_accounts_by_day", """
SELECT transaction_day, COUNT(DISTINCT origin_account) AS unique_origin_accounts,
  COUNT(DISTINCT destination_account) AS unique_destination_accounts
FROM silver_m GROUP BY transaction_day""", "silver_m")

# ------------------------------------------------------------------ ruled silver
oracle("normalize_strings", """
SELECT upper(trim(type)) AS transaction_type, trim(nameOrig) AS origin_account, trim(nameDest) AS destination_account
FROM raw""", "raw")
oracle("destination_category", """
SELECT origin_account, destination_account, destination_category,
  CAST(destination_category = 'CUSTOMER' AS INTEGER) AS is_customer_destination,
  CAST(destination_category = 'MERCHANT' AS INTEGER) AS is_merchant_destination,
  is_self_transfer,
  CASE WHEN destination_category = 'MERCHANT' THEN 0 ELSE 1 END AS destination_balance_available
FROM enriched2_n""", "enriched2_n")
oracle("amount_category", "SELECT amount, amount_category, is_high_value_transaction, is_zero_amount FROM enriched2_n",
       "enriched2_n")

from oracle.sql import HARD_RULES, WARNING_RULES  # noqa: E402

oracle("hard_rules", "SELECT _record_hash, " + ", ".join(n for _, n, _ in HARD_RULES)
       + ", hard_failure_count FROM validated_n", "validated_n")
oracle("warning_rules", "SELECT _record_hash, " + ", ".join(n for _, n, _ in WARNING_RULES)
       + ", warning_count FROM validated_n", "validated_n")
oracle("failure_reasons", """
SELECT _record_hash, hard_failure_reason_text, warning_reason_text,
  CAST(hard_failure_reason_count AS INTEGER) AS hard_failure_reason_count,
  CAST(warning_reason_count AS INTEGER) AS warning_reason_count
FROM validated_n""", "validated_n")
oracle("validation_status", "SELECT _record_hash, hard_failure_count, warning_count, validation_status FROM validated_n",
       "validated_n")

SILVER_RULED_SELECT = """
SELECT _record_hash, step, transaction_day, hour_of_day, transaction_type, amount, amount_category, origin_account,
  destination_account, destination_category, is_customer_destination, is_merchant_destination, old_balance_origin,
  new_balance_origin, old_balance_destination, new_balance_destination, destination_balance_available,
  is_high_value_transaction, is_zero_amount, is_self_transfer, is_fraud, is_flagged_fraud, validation_status,
  warning_count, warning_reason_text, _pipeline_run_id, _source_file, _source_file_path
FROM silver_n"""
oracle("silver_ruled", SILVER_RULED_SELECT, "silver_n")
oracle("quarantine", """
SELECT _record_hash, step, transaction_type, amount, origin_account, destination_account, is_fraud,
  is_flagged_fraud, validation_status, hard_failure_count, hard_failure_reason_text, warning_count,
  warning_reason_text, _pipeline_run_id, _source_file, _source_file_path
FROM quarantine_n""", "quarantine_n")


def _rule_counts(kind: str, rules, source: str) -> str:
    parts = [
        f"SELECT '{kind}' AS rule_kind, '{code}' AS rule_code, {i + 1} AS rule_order, "
        f"CAST(coalesce(SUM({name}), 0) AS BIGINT) AS failed_records FROM {source}"
        for i, (code, name, _) in enumerate(rules)
    ]
    return "\nUNION ALL\n".join(parts)


oracle("hard_rule_counts", _rule_counts("HARD", HARD_RULES, "validated_n"), "validated_n")
oracle("warning_rule_counts", _rule_counts("WARNING", WARNING_RULES, "silver_n"), "silver_n")
oracle("validation_status_summary", f"""
SELECT validation_status, COUNT(*) AS record_count, {bigint_sum('is_fraud')} AS fraud_count, {TOTAL} AS total_amount
FROM validated_n GROUP BY validation_status""", "validated_n")
oracle("warning_records", """
SELECT _record_hash, step, transaction_type, amount, origin_account, destination_account, warning_count,
  warning_reason_text
FROM silver_n WHERE validation_status = 'VALID_WITH_WARNING'""", "silver_n")

# ------------------------------------------------------------------ ruled gold
oracle("daily_transaction_summary_exact", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct,
  {safe_pct('fraud_amount', 'total_transaction_amount')} AS fraud_amount_pct
FROM (
  SELECT transaction_day, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {AVG} AS average_transaction_amount, {MIN} AS minimum_transaction_amount, {MAX} AS maximum_transaction_amount,
    {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count,
    COUNT(DISTINCT origin_account) AS unique_origin_accounts,
    COUNT(DISTINCT destination_account) AS unique_destination_accounts
  FROM silver_n GROUP BY transaction_day) g""", "silver_n")

oracle("hourly_fraud_profile", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct,
  {safe_pct('flagged_fraud_count', 'fraud_count')} AS flag_coverage_pct
FROM (
  SELECT step, transaction_day, hour_of_day, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count,
    COUNT(DISTINCT origin_account) AS unique_origin_accounts,
    COUNT(DISTINCT destination_account) AS unique_destination_accounts
  FROM silver_n GROUP BY step, transaction_day, hour_of_day) g""", "silver_n")

oracle("transaction_type_profile", f"""
SELECT *, {safe_pct('transaction_count', 'SUM(transaction_count) OVER ()', 4)} AS transaction_pct,
  {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct
FROM (
  SELECT transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {AVG} AS average_amount,
    {sround('quantile_disc(amount, 0.5)', 2)} AS median_amount, {MIN} AS minimum_amount, {MAX} AS maximum_amount,
    {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count
  FROM silver_n GROUP BY transaction_type) g""", "silver_n")

oracle("origin_account_profile", f"""
SELECT *, {safe_pct('fraud_transaction_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT origin_account, COUNT(*) AS transaction_count, {TOTAL} AS total_transaction_amount,
    {AVG} AS average_transaction_amount, {MIN} AS minimum_transaction_amount, {MAX} AS maximum_transaction_amount,
    COUNT(DISTINCT destination_account) AS unique_destination_count,
    COUNT(DISTINCT transaction_type) AS unique_transaction_type_count,
    MIN(step) AS first_transaction_step, MAX(step) AS last_transaction_step,
    {bigint_sum('is_fraud')} AS fraud_transaction_count, {FRAUD_AMT} AS fraud_transaction_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_transaction_count,
    CAST(COUNT(*) FILTER (WHERE transaction_type = 'TRANSFER') AS BIGINT) AS transfer_count,
    CAST(COUNT(*) FILTER (WHERE transaction_type = 'CASH_OUT') AS BIGINT) AS cash_out_count,
    CAST(COUNT(*) FILTER (WHERE transaction_type = 'PAYMENT') AS BIGINT) AS payment_count
  FROM silver_n GROUP BY origin_account) g""", "silver_n")

_DEST_PROFILE = f"""
SELECT *, {safe_pct('fraud_received_count', 'received_transaction_count')} AS fraud_received_rate_pct FROM (
  SELECT destination_account, destination_category, COUNT(*) AS received_transaction_count,
    {TOTAL} AS received_total_amount, {AVG} AS received_average_amount, {MAX} AS received_maximum_amount,
    COUNT(DISTINCT origin_account) AS unique_origin_count, MIN(step) AS first_received_step,
    MAX(step) AS last_received_step, {bigint_sum('is_fraud')} AS fraud_received_count,
    {FRAUD_AMT} AS fraud_received_amount, {bigint_sum('is_flagged_fraud')} AS flagged_fraud_received_count,
    {bigint_sum('is_high_value_transaction')} AS high_value_received_count
  FROM silver_n GROUP BY destination_account, destination_category) g"""
oracle("destination_account_profile", _DEST_PROFILE, "silver_n")
oracle("top_risky_destinations", f"""
SELECT * FROM ({_DEST_PROFILE}) p WHERE fraud_received_count > 0
ORDER BY fraud_received_count DESC, fraud_received_amount DESC, destination_account ASC LIMIT 20""", "silver_n")

oracle("high_value_profile", f"""
SELECT *, {safe_pct('high_value_fraud_count', 'high_value_transaction_count')} AS high_value_fraud_rate_pct FROM (
  SELECT transaction_day, transaction_type, COUNT(*) AS high_value_transaction_count,
    {TOTAL} AS high_value_total_amount, {AVG} AS high_value_average_amount, {MAX} AS high_value_maximum_amount,
    {bigint_sum('is_fraud')} AS high_value_fraud_count, {bigint_sum('is_flagged_fraud')} AS high_value_flagged_count
  FROM silver_n WHERE is_high_value_transaction = 1 GROUP BY transaction_day, transaction_type) g""", "silver_n")

oracle("fraud_monitoring_profile", """
SELECT _record_hash, step, transaction_day, hour_of_day, transaction_type, amount, amount_category,
  origin_account, destination_account, destination_category, is_high_value_transaction, is_flagged_fraud,
  _pipeline_run_id, _source_file
FROM silver_n WHERE is_fraud = 1""", "silver_n")

oracle("daily_type_profile", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT transaction_day, transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount,
    {AVG} AS average_amount, {bigint_sum('is_fraud')} AS fraud_count, {FRAUD_AMT} AS fraud_amount,
    {bigint_sum('is_flagged_fraud')} AS flagged_fraud_count
  FROM silver_n GROUP BY transaction_day, transaction_type) g""", "silver_n")

_W = "OVER (PARTITION BY origin_account ORDER BY step, _record_hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_L = "OVER (PARTITION BY origin_account ORDER BY step, _record_hash)"
oracle("fraud_feature_profile", f"""
SELECT _record_hash, step, transaction_day, hour_of_day, transaction_type, amount, amount_category, origin_account,
  destination_account, destination_category, is_customer_destination, is_merchant_destination,
  is_high_value_transaction,
  CAST(transaction_type = 'CASH_IN' AS INTEGER) AS is_cash_in,
  CAST(transaction_type = 'CASH_OUT' AS INTEGER) AS is_cash_out,
  CAST(transaction_type = 'DEBIT' AS INTEGER) AS is_debit,
  CAST(transaction_type = 'PAYMENT' AS INTEGER) AS is_payment,
  CAST(transaction_type = 'TRANSFER' AS INTEGER) AS is_transfer,
  COUNT(*) {_W} AS prior_origin_transaction_count,
  {sround(f'coalesce(SUM(amount) {_W}, 0.0)', 2)} AS prior_origin_total_amount,
  {sround(f'coalesce(AVG(amount) {_W}, 0.0)', 2)} AS prior_origin_average_amount,
  {sround(f'coalesce(MAX(amount) {_W}, 0.0)', 2)} AS prior_origin_maximum_amount,
  CAST(coalesce(SUM(is_fraud) {_W}, 0) AS BIGINT) AS prior_origin_fraud_count,
  LAG(step) {_L} AS previous_transaction_step,
  coalesce(LAG(amount) {_L}, 0.0) AS previous_transaction_amount,
  CAST(coalesce(step - LAG(step) {_L}, -1) AS INTEGER) AS steps_since_previous_transaction,
  is_flagged_fraud, is_fraud, _pipeline_run_id, _source_file
FROM silver_n""", "silver_n")

oracle("raw_type_summary", f"""
SELECT *, {safe_pct('fraud_count', 'transaction_count')} AS fraud_rate_pct FROM (
  SELECT type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {AVG} AS average_amount,
    {MIN} AS minimum_amount, {MAX} AS maximum_amount, {bigint_sum('isFraud')} AS fraud_count,
    {bigint_sum('isFlaggedFraud')} AS flagged_fraud_count
  FROM raw GROUP BY type) g""", "raw")


# ------------------------------------------------------------------ quality
_RAWC = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest",
         "newbalanceDest", "isFraud", "isFlaggedFraud"]
_RAWT = {"step": "int", "type": "string", "amount": "double", "nameOrig": "string", "oldbalanceOrg": "double",
         "newbalanceOrig": "double", "nameDest": "string", "oldbalanceDest": "double", "newbalanceDest": "double",
         "isFraud": "int", "isFlaggedFraud": "int"}
_NUM = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
_BAL = _NUM[1:]
_TYPES = "('CASH_IN','CASH_OUT','DEBIT','PAYMENT','TRANSFER')"


def _cnt(pred: str) -> str:
    return f"CAST(count_if({pred}) AS BIGINT)"


oracle("null_profile", "SELECT " + ", ".join(f"{_cnt(f'{c} IS NULL')} AS {c}" for c in _RAWC) + " FROM raw", "raw")
oracle("null_profile_long", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {_cnt(f'{c} IS NULL')} AS null_count, "
    f"CASE WHEN COUNT(*) > 0 THEN {sround(f'count_if({c} IS NULL) / COUNT(*) * 100.0', 6)} ELSE 0.0 END AS null_pct FROM raw"
    for c in _RAWC), "raw")


def _dups(keys: str, source: str, groups_name: str, rows_name: str, with_groups: bool = True) -> str:
    sel = (f"CAST(COUNT(*) AS BIGINT) AS {groups_name}, " if with_groups else "") + \
        f"CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS {rows_name}"
    return f"SELECT {sel} FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1) g"


oracle("duplicate_keys", _dups("step, type, amount, nameOrig, nameDest", "raw", "duplicate_groups", "duplicate_rows"), "raw")
oracle("duplicate_hashes", _dups("_record_hash", "bronze_n", "duplicate_hash_groups", "duplicate_records"), "bronze_n")
oracle("duplicate_rows", _dups(", ".join(_RAWC), "raw", "", "exact_duplicate_rows", with_groups=False), "raw")
oracle("nonbinary_values", """
SELECT DISTINCT 'isFraud' AS column_name, CAST(isFraud AS BIGINT) AS value FROM raw
WHERE isFraud IS NOT NULL AND isFraud NOT IN (0, 1)
UNION ALL
SELECT DISTINCT 'isFlaggedFraud' AS column_name, CAST(isFlaggedFraud AS BIGINT) AS value FROM raw
WHERE isFlaggedFraud IS NOT NULL AND isFlaggedFraud NOT IN (0, 1)""", "raw")
oracle("invalid_types", f"SELECT step, type, amount, nameOrig FROM raw WHERE type NOT IN {_TYPES} OR type IS NULL", "raw")
oracle("bronze_validation_metrics", f"""
SELECT {_cnt(f'type NOT IN {_TYPES} OR type IS NULL')} AS invalid_transaction_type_count,
  {_cnt('NOT (step BETWEEN 1 AND 744) OR step IS NULL')} AS invalid_step_count,
  {_cnt('amount < 0 OR amount IS NULL')} AS invalid_amount_count,
  {_cnt('isFraud NOT IN (0, 1) OR isFraud IS NULL')} AS invalid_fraud_flag_count,
  {_cnt('isFlaggedFraud NOT IN (0, 1) OR isFlaggedFraud IS NULL')} AS invalid_flagged_fraud_count
FROM raw""", "raw")
oracle("numeric_validation", f"""
SELECT {_cnt('amount < 0')} AS negative_amount_count, {_cnt('amount = 0')} AS zero_amount_count,
  {_cnt('isFraud NOT IN (0, 1)')} AS invalid_fraud_flag_count,
  {_cnt('isFlaggedFraud NOT IN (0, 1)')} AS invalid_flagged_fraud_count
FROM raw""", "raw")
oracle("silver_binary_metrics", f"""
SELECT {_cnt('is_fraud NOT IN (0, 1)')} AS invalid_is_fraud_count,
  {_cnt('is_flagged_fraud NOT IN (0, 1)')} AS invalid_is_flagged_fraud_count,
  {_cnt('is_high_value_transaction NOT IN (0, 1)')} AS invalid_high_value_count
FROM silver_m""", "silver_m")
oracle("flag_detection_rate", f"""
SELECT fraud_count, flagged_fraud_count,
  CASE WHEN fraud_count > 0 THEN flagged_fraud_count / fraud_count * 100.0 ELSE 0.0 END AS flag_detection_rate_pct
FROM (SELECT {_cnt('isFraud = 1')} AS fraud_count, {_cnt('isFraud = 1 AND isFlaggedFraud = 1')} AS flagged_fraud_count
      FROM raw) g""", "raw")
oracle("cardinality_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{_RAWT[c]}' AS data_type, "
    f"CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_count, "
    f"(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) / COUNT(*) * 100.0 AS cardinality_pct FROM raw"
    for c in _RAWC), "raw")
oracle("column_cardinality", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_count FROM raw" for c in _RAWC), "raw")
oracle("origin_prefix_counts", f"""
SELECT substring(nameOrig, 1, 1) AS origin_prefix, COUNT(*) AS transaction_count,
  {_cnt('amount > 200000')} AS high_amount_count
FROM raw GROUP BY substring(nameOrig, 1, 1)""", "raw")

_DESCRIBE = {0.01: "p01", 0.05: "p05", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95", 0.99: "p99"}
_QUART = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def _describe(source: str, cols, probs) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        qs = ", ".join(f"{sround(f'quantile_cont({v}, {p})', 6)} AS {n}" for p, n in probs.items())
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(COUNT({v}) AS BIGINT) AS count, {sround(f'AVG({v})', 6)} AS mean, "
            f"{sround(f'stddev_samp({v})', 6)} AS std, {sround(f'MIN({v})', 6)} AS min, {qs}, "
            f"{sround(f'MAX({v})', 6)} AS max FROM {source}")
    return "\nUNION ALL\n".join(parts)


oracle("numeric_profile", _describe("raw", ["step", *_NUM], _DESCRIBE), "raw")
oracle("type_quality_profile", """
SELECT type, COUNT(*) AS transaction_count, SUM(amount) AS total_amount, AVG(amount) AS average_amount,
  quantile_cont(amount, 0.5) AS median_amount, MAX(amount) AS maximum_amount,
  CAST(SUM(isFraud) AS BIGINT) AS fraud_count, CAST(SUM(isFlaggedFraud) AS BIGINT) AS flagged_fraud_count,
  COUNT(*) / (SELECT COUNT(*) FROM raw) * 100.0 AS transaction_pct,
  CAST(SUM(isFraud) AS BIGINT) / COUNT(*) * 100.0 AS fraud_rate_pct
FROM raw WHERE type IS NOT NULL GROUP BY type""", "raw")
oracle("flag_profile", """
SELECT type, isFlaggedFraud, COUNT(*) AS transaction_count, MIN(amount) AS minimum_amount,
  MAX(amount) AS maximum_amount, AVG(amount) AS average_amount
FROM raw WHERE type IS NOT NULL AND isFlaggedFraud IS NOT NULL GROUP BY type, isFlaggedFraud""", "raw")
oracle("fraud_by_type", """
SELECT type, COUNT(*) AS transaction_count, CAST(SUM(isFraud) AS BIGINT) AS fraud_count, SUM(amount) AS total_amount,
  CAST(SUM(isFraud) AS BIGINT) / COUNT(*) * 100.0 AS fraud_rate_pct
FROM raw WHERE type IS NOT NULL GROUP BY type""", "raw")
_HOURLY = """
SELECT step, COUNT(*) AS transaction_count, SUM(amount) AS total_amount, AVG(amount) AS average_amount,
  CAST(SUM(isFraud) AS BIGINT) AS fraud_count, CAST(SUM(isFlaggedFraud) AS BIGINT) AS flagged_fraud_count,
  CAST(SUM(isFraud) AS BIGINT) / COUNT(*) * 100.0 AS fraud_rate_pct
FROM raw WHERE step IS NOT NULL GROUP BY step"""
oracle("hourly_profile", _HOURLY, "raw")
oracle("hourly_profile_stats",
       _describe(f"({_HOURLY}) hp", ["transaction_count", "total_amount", "fraud_count", "fraud_rate_pct"], _QUART), "raw")
oracle("merchant_balance_profile",
       _describe("(SELECT * FROM raw WHERE starts_with(nameDest, 'M')) mb", ["oldbalanceDest", "newbalanceDest"], _QUART),
       "raw")
oracle("type_distribution", f"""
SELECT type, transaction_count, {sround('transaction_count / SUM(transaction_count) OVER () * 100.0', 4)} AS transaction_pct
FROM (SELECT type, COUNT(*) AS transaction_count FROM raw GROUP BY type) g""", "raw")
oracle("fraud_distribution", f"""
SELECT isFraud, transaction_count, {sround('transaction_count / SUM(transaction_count) OVER () * 100.0', 6)} AS transaction_pct
FROM (SELECT isFraud, COUNT(*) AS transaction_count FROM raw GROUP BY isFraud) g""", "raw")
oracle("fraud_flag_crosstab", """
SELECT CASE WHEN GROUPING(isFraud) = 1 THEN 'All' ELSE CAST(isFraud AS VARCHAR) END AS is_fraud,
  CASE WHEN GROUPING(isFlaggedFraud) = 1 THEN 'All' ELSE CAST(isFlaggedFraud AS VARCHAR) END AS is_flagged_fraud,
  COUNT(*) AS transaction_count
FROM raw WHERE isFraud IS NOT NULL AND isFlaggedFraud IS NOT NULL
GROUP BY CUBE (isFraud, isFlaggedFraud)""", "raw")
oracle("missing_steps", """
SELECT CAST(range AS INTEGER) AS step FROM range(1, 745)
WHERE range NOT IN (SELECT DISTINCT step FROM raw WHERE step IS NOT NULL)""", "raw")

# The check report as the contract states it: (name, category, severity, description).
_SCHEMA_META = [
    ("expected_columns_present", "schema", "ERROR", "Every column of the contract is there."),
    ("no_unexpected_columns", "schema", "WARNING", "No column is there that the contract lacks."),
    ("expected_column_order", "schema", "WARNING", "Columns come in the contract's order."),
]
_DUPLICATE_META = ("no_exact_duplicate_rows", "uniqueness", "ERROR", "No row repeats another in all columns.")
_STEPS_META = ("all_expected_steps_present", "completeness", "WARNING", "Each step of the month has a row.")
_ROW_META = [(f"{c}_not_null", "completeness", "ERROR", f"No row lacks {c}.") for c in _RAWC]
_ROW_META += [
    ("valid_transaction_type", "validity", "ERROR", "The type is one of the five known ones."),
    ("valid_step_range", "validity", "ERROR", "The step lies in the simulated month (1 to 744)."),
    ("non_negative_amount", "validity", "ERROR", "No amount is below zero."),
    ("non_zero_amount", "business_rule", "WARNING", "Amounts of zero are counted for review and kept."),
]
_ROW_META += [(f"{c}_finite", "validity", "ERROR", f"No value of {c} is infinite.") for c in _NUM]
_ROW_META += [(f"{c}_non_negative", "validity", "ERROR", f"No value of {c} is below zero.") for c in _BAL]
_ROW_META += [(f"{c}_binary", "validity", "ERROR", f"{c} is 0 or 1.") for c in ["isFraud", "isFlaggedFraud"]]
_ROW_META += [
    ("valid_origin_account_format", "validity", "ERROR", "Sending accounts read C and digits."),
    ("valid_destination_account_format", "validity", "ERROR", "Receiving accounts read C or M and digits."),
    ("no_self_transfer", "business_rule", "WARNING", "Sender and receiver differ."),
    ("merchant_destination_balance_unavailable", "business_rule", "WARNING", "Balances of receiving merchants are zero, as they are not recorded."),
    ("outgoing_origin_balance_reconciliation", "consistency", "WARNING", "The sender's new balance is the old one less the amount, within the tolerance."),
    ("cash_in_origin_balance_reconciliation", "consistency", "WARNING", "After a cash-in the new balance is the old one plus the amount, within the tolerance."),
    ("fraud_transaction_type_consistency", "business_rule", "WARNING", "Fraud occurs in transfers and cash-outs only."),
    ("flagged_fraud_threshold_rule", "business_rule", "WARNING", "Flagged rows are transfers above the threshold."),
    ("high_value_transfer_flag_coverage", "business_rule", "WARNING", "Transfers above the threshold carry the flag."),
]

_CHECK_SQL = {}
for _c in _RAWC:
    _CHECK_SQL[f"{_c}_not_null"] = (f"{_c} IS NULL", None)
_CHECK_SQL["valid_transaction_type"] = (f"NOT coalesce(type IN {_TYPES}, false)", None)
_CHECK_SQL["valid_step_range"] = ("NOT coalesce(step BETWEEN 1 AND 744, false)", None)
_CHECK_SQL["non_negative_amount"] = ("amount < 0", None)
_CHECK_SQL["non_zero_amount"] = ("amount = 0", None)
for _c in _NUM:
    _CHECK_SQL[f"{_c}_finite"] = (f"isinf({_c})", None)
for _c in _BAL:
    _CHECK_SQL[f"{_c}_non_negative"] = (f"{_c} < 0", None)
for _c in ["isFraud", "isFlaggedFraud"]:
    _CHECK_SQL[f"{_c}_binary"] = (f"NOT coalesce({_c} IN (0, 1), false)", None)
_CHECK_SQL["valid_origin_account_format"] = ("NOT coalesce(regexp_matches(nameOrig, '^C[0-9]+$'), false)", None)
_CHECK_SQL["valid_destination_account_format"] = ("NOT coalesce(regexp_matches(nameDest, '^[CM][0-9]+$'), false)", None)
_CHECK_SQL["no_self_transfer"] = ("nameOrig = nameDest", None)
_MER = "coalesce(starts_with(nameDest, 'M'), false)"
_CHECK_SQL["merchant_destination_balance_unavailable"] = (
    f"{_MER} AND (coalesce(oldbalanceDest <> 0, true) OR coalesce(newbalanceDest <> 0, true))", _MER)
_OUT = "coalesce(type IN ('PAYMENT','TRANSFER','CASH_OUT','DEBIT'), false)"
_CHECK_SQL["outgoing_origin_balance_reconciliation"] = (
    f"{_OUT} AND abs(oldbalanceOrg - amount - newbalanceOrig) > 0.01", _OUT)
_CIN = "coalesce(type = 'CASH_IN', false)"
_CHECK_SQL["cash_in_origin_balance_reconciliation"] = (
    f"{_CIN} AND abs(oldbalanceOrg + amount - newbalanceOrig) > 0.01", _CIN)
_FR = "coalesce(isFraud = 1, false)"
_CHECK_SQL["fraud_transaction_type_consistency"] = (
    f"{_FR} AND NOT coalesce(type IN ('TRANSFER','CASH_OUT'), false)", _FR)
_FL = "coalesce(isFlaggedFraud = 1, false)"
_CHECK_SQL["flagged_fraud_threshold_rule"] = (
    f"{_FL} AND (coalesce(type <> 'TRANSFER', true) OR coalesce(amount <= 200000.0, false))", _FL)
_BT = "coalesce(type = 'TRANSFER' AND amount > 200000.0, false)"
_CHECK_SQL["high_value_transfer_flag_coverage"] = (f"{_BT} AND coalesce(isFlaggedFraud = 0, false)", _BT)


def _q(s: str) -> str:
    return s.replace("'", "''")


def _report_row(name, category, severity, description, tested_sql, failed_sql, source="raw"):
    return (f"SELECT '{name}' AS check_name, '{category}' AS check_category, '{_q(description)}' AS description, "
            f"'{severity}' AS severity, CAST({tested_sql} AS BIGINT) AS records_tested, "
            f"CAST({failed_sql} AS BIGINT) AS failed_records FROM {source}")


def _quality_report_sql() -> str:
    parts = [
        _report_row(*_SCHEMA_META[0], "11", "0", source="(SELECT 1) s"),
        _report_row(*_SCHEMA_META[1], "11", "0", source="(SELECT 1) s"),
        _report_row(*_SCHEMA_META[2], "1", "0", source="(SELECT 1) s"),
    ]
    for meta in _ROW_META:
        failed, tested = _CHECK_SQL[meta[0]]
        parts.append(_report_row(*meta, f"count_if({tested})" if tested else "COUNT(*)", f"count_if({failed})"))
    parts.append(_report_row(*_DUPLICATE_META, "SUM(n)", "coalesce(SUM(CASE WHEN n > 1 THEN n - 1 END), 0)",
                             source="(SELECT COUNT(*) AS n FROM raw GROUP BY " + ", ".join(_RAWC) + ") d"))
    parts.append(_report_row(*_STEPS_META, "744", "COUNT(*)",
                             source="range(1, 745) WHERE range NOT IN (SELECT DISTINCT step FROM raw WHERE step IS NOT NULL)"))
    body = "\nUNION ALL\n".join(parts)
    return f"""
SELECT check_name, check_category, description, severity, records_tested, failed_records,
  CASE WHEN records_tested > 0 THEN failed_records / records_tested * 100.0 ELSE 0.0 END AS failure_rate_pct,
  CASE WHEN failed_records = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({body}) r"""


_REPORT = _quality_report_sql()
oracle("quality_report", _REPORT, "raw")
oracle("quality_failed_checks", f"SELECT * FROM ({_REPORT}) q WHERE status = 'FAIL'", "raw")
oracle("quality_status_counts", f"SELECT status, COUNT(*) AS check_count FROM ({_REPORT}) q GROUP BY status", "raw")
oracle("quality_category_matrix", f"""
SELECT check_category, {_cnt("status = 'PASS'")} AS "PASS", {_cnt("status = 'FAIL'")} AS "FAIL"
FROM ({_REPORT}) q GROUP BY check_category""", "raw")

oracle("distinct_types", "SELECT DISTINCT type FROM raw", "raw")
oracle("time_range", """
SELECT MIN(transaction_day) AS minimum_day, MAX(transaction_day) AS maximum_day,
  MIN(hour_of_day) AS minimum_hour, MAX(hour_of_day) AS maximum_hour
FROM enriched2_n""", "enriched2_n")
oracle("amount_category_counts",
       "SELECT amount_category, COUNT(*) AS transaction_count FROM enriched2_n GROUP BY amount_category", "enriched2_n")
oracle("destination_category_counts",
       "SELECT destination_category, COUNT(*) AS transaction_count FROM enriched2_n GROUP BY destination_category",
       "enriched2_n")
oracle("fraud_only_by_type", f"""
SELECT type, COUNT(*) AS fraud_count, {sround('SUM(amount)', 2)} AS fraud_amount
FROM raw WHERE isFraud = 1 GROUP BY type""", "raw")
oracle("high_value_fraud",
       "SELECT step, type, amount, nameOrig, nameDest FROM raw WHERE isFraud = 1 AND amount > 200000", "raw")
oracle("balance_abs_errors", """
SELECT step, type, amount, abs(oldbalanceOrg - amount - newbalanceOrig) AS origin_outgoing_balance_error,
  abs(oldbalanceOrg + amount - newbalanceOrig) AS origin_cash_in_balance_error
FROM raw""", "raw")
oracle("type_one_hot", """
SELECT _record_hash, transaction_type,
  CAST(transaction_type = 'CASH_IN' AS INTEGER) AS is_cash_in, CAST(transaction_type = 'CASH_OUT' AS INTEGER) AS is_cash_out,
  CAST(transaction_type = 'DEBIT' AS INTEGER) AS is_debit, CAST(transaction_type = 'PAYMENT' AS INTEGER) AS is_payment,
  CAST(transaction_type = 'TRANSFER' AS INTEGER) AS is_transfer
FROM silver_n""", "silver_n")
oracle("exact_quantiles", "SELECT transaction_type, " + ", ".join(
    f"{sround(f'quantile_cont(amount, {p})', 6)} AS {n}" for p, n in
    {0.01: "p01", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95", 0.99: "p99"}.items())
    + " FROM silver_m GROUP BY transaction_type", "silver_m")

# ------------------------------------------------------------------ SQL surface
_RATE = sround("CAST(SUM(isFraud) AS DOUBLE) * 100.0 / COUNT(*)", 6)
oracle("sql_type_summary", f"""
SELECT type AS transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {AVG} AS average_amount,
  {bigint_sum('isFraud')} AS fraud_count, {_RATE} AS fraud_rate_pct
FROM raw GROUP BY type""", "raw")
oracle("top_fraud", """
SELECT step, type, amount, nameOrig, nameDest, isFlaggedFraud FROM raw WHERE isFraud = 1
ORDER BY amount DESC NULLS LAST, step ASC NULLS FIRST, nameOrig ASC NULLS FIRST, nameDest ASC NULLS FIRST LIMIT 10""", "raw")
oracle("sql_hourly_summary", f"""
SELECT step, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {bigint_sum('isFraud')} AS fraud_count,
  {_RATE} AS fraud_rate_pct
FROM raw GROUP BY step""", "raw")
oracle("sql_bronze_type_counts",
       f"SELECT type, COUNT(*) AS transaction_count, {bigint_sum('isFraud')} AS fraud_count FROM bronze_n GROUP BY type",
       "bronze_n")
oracle("sql_silver_type_summary", f"""
SELECT transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {bigint_sum('is_fraud')} AS fraud_count,
  {sround('CAST(SUM(is_fraud) AS DOUBLE) * 100.0 / COUNT(*)', 6)} AS fraud_rate_pct
FROM silver_n GROUP BY transaction_type""", "silver_n")
oracle("sql_status_summary", f"""
SELECT validation_status, COUNT(*) AS record_count, {bigint_sum('is_fraud')} AS fraud_count
FROM silver_n GROUP BY validation_status""", "silver_n")
oracle("sql_gold_type_lookup", f"""
SELECT transaction_type, COUNT(*) AS transaction_count, {TOTAL} AS total_amount, {bigint_sum('is_fraud')} AS fraud_count,
  {FRAUD_AMT} AS fraud_amount, {safe_pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct
FROM silver_n GROUP BY transaction_type""", "silver_n")

# ------------------------------------------------------------------ reconciliation and audit
oracle("count_reconciliation", """
SELECT s.n AS source_row_count, t.n AS target_row_count, t.n - s.n AS row_count_difference,
  CASE WHEN s.n = t.n THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status
FROM (SELECT COUNT(*) AS n FROM bronze_m) s, (SELECT COUNT(*) AS n FROM silver_m) t""", "silver_m")
oracle("partition_reconciliation", """
SELECT COUNT(*) AS bronze_record_count, CAST(count_if(hard_failure_count = 0) AS BIGINT) AS silver_record_count,
  CAST(count_if(hard_failure_count > 0) AS BIGINT) AS quarantine_record_count,
  CASE WHEN COUNT(*) = count_if(hard_failure_count = 0) + count_if(hard_failure_count > 0) THEN 'PASS' ELSE 'FAIL' END
    AS reconciliation_status
FROM validated_n""", "validated_n")

_MEASURES_M = {
    "bronze_rows": "SELECT COUNT(*) FROM bronze_m",
    "silver_rows": "SELECT COUNT(*) FROM silver_m",
    "silver_fraud": "SELECT coalesce(SUM(is_fraud), 0) FROM silver_m",
    "silver_high_value": "SELECT coalesce(SUM(is_high_value_transaction), 0) FROM silver_m",
    "daily_rows": "SELECT COUNT(*) FROM silver_m",
    "daily_fraud": "SELECT coalesce(SUM(is_fraud), 0) FROM silver_m",
    "daily_type_rows": "SELECT COUNT(*) FROM silver_m",
    "hourly_rows": "SELECT COUNT(*) FROM silver_m",
    "type_rows": "SELECT COUNT(*) FROM silver_m",
    "high_value_rows": "SELECT COUNT(*) FROM silver_m WHERE is_high_value_transaction = 1",
    "monitoring_rows": "SELECT COUNT(*) FROM silver_m WHERE is_fraud = 1",
    "feature_rows": "SELECT COUNT(*) FROM silver_m",
    "origin_rows": "SELECT COUNT(*) FROM silver_m",
    "destination_rows": "SELECT COUNT(*) FROM silver_m",
}
_CHECKS_M = [
    ("bronze_to_silver_bound", "bronze_rows", "silver_rows", "le"),
    ("daily_count", "silver_rows", "daily_rows", "eq"),
    ("daily_type_count", "silver_rows", "daily_type_rows", "eq"),
    ("hourly_count", "silver_rows", "hourly_rows", "eq"),
    ("type_count", "silver_rows", "type_rows", "eq"),
    ("high_value_count", "silver_high_value", "high_value_rows", "eq"),
    ("daily_fraud", "silver_fraud", "daily_fraud", "eq"),
    ("fraud_monitoring_rows", "silver_fraud", "monitoring_rows", "eq"),
    ("fraud_feature_rows", "silver_rows", "feature_rows", "eq"),
    ("origin_account_count", "silver_rows", "origin_rows", "eq"),
    ("destination_account_count", "silver_rows", "destination_rows", "eq"),
]


def _comparison(measures: dict, checks) -> str:
    rows = []
    for name, e, a, rel in checks:
        ev, av = f"CAST(({measures[e]}) AS BIGINT)", f"CAST(({measures[a]}) AS BIGINT)"
        ok = f"{ev} = {av}" if rel == "eq" else f"{av} >= 0 AND {av} <= {ev}"
        rows.append(f"SELECT '{name}' AS check_name, '{e}' AS expected_measure, '{a}' AS actual_measure, "
                    f"{ev} AS expected_value, {av} AS actual_value, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status")
    return "\nUNION ALL\n".join(rows)


_RECON = _comparison(_MEASURES_M, _CHECKS_M)
oracle("reconciliation_report", _RECON, "silver_m")
_STATUS = f"""
SELECT CAST(count_if(status <> 'PASS') AS BIGINT) AS failed_checks, COUNT(*) AS checks,
  CASE WHEN count_if(status <> 'PASS') = 0 THEN 'SUCCESS' ELSE 'COMPLETED_WITH_VALIDATION_FAILURE' END AS pipeline_status
FROM ({_RECON}) r"""
oracle("pipeline_status", _STATUS, "silver_m")

_GOLD_M = {  # table -> (column count, row-count query)
    "daily_transaction_summary": (14, "SELECT COUNT(DISTINCT transaction_day) FROM silver_m"),
    "daily_type_summary": (8, "SELECT COUNT(*) FROM (SELECT DISTINCT transaction_day, transaction_type FROM silver_m) x"),
    "destination_account_summary": (6, "SELECT COUNT(DISTINCT destination_account) FROM silver_m"),
    "fraud_feature": (13, "SELECT COUNT(*) FROM silver_m"),
    "fraud_monitoring": (11, "SELECT COUNT(*) FROM silver_m WHERE is_fraud = 1"),
    "high_value_summary": (6, "SELECT COUNT(*) FROM (SELECT DISTINCT transaction_day, transaction_type FROM silver_m "
                              "WHERE is_high_value_transaction = 1) x"),
    "hourly_fraud_summary": (6, "SELECT COUNT(DISTINCT step) FROM silver_m"),
    "origin_account_summary": (6, "SELECT COUNT(DISTINCT origin_account) FROM silver_m"),
    "transaction_type_summary": (8, "SELECT COUNT(DISTINCT transaction_type) FROM silver_m"),
}
# Which checks decide a table's status; the layers' own checks are restated in SQL.
_LAYERS = """
SELECT 'bronze_source_count' AS check_name, CAST((SELECT COUNT(*) FROM raw) AS BIGINT) AS expected_value,
  CAST((SELECT COUNT(*) FROM bronze_m) AS BIGINT) AS actual_value
UNION ALL SELECT 'amounts_summable', CAST(0 AS BIGINT), CAST((SELECT count_if(isinf(amount) OR isnan(amount)) FROM silver_m) AS BIGINT)"""
_FRAUD_ROWS = "CAST((SELECT COUNT(*) FROM silver_m WHERE is_fraud = 1) AS BIGINT)"
_JOB_CHECKS = f"""
SELECT check_name, expected_value, actual_value, status FROM ({_RECON}) r
UNION ALL SELECT check_name, expected_value, actual_value, CASE WHEN expected_value = actual_value THEN 'PASS' ELSE 'FAIL' END FROM ({_LAYERS}) l
UNION ALL SELECT 'fraud_export_rows', {_FRAUD_ROWS}, {_FRAUD_ROWS}, 'PASS'
UNION ALL SELECT 'fraud_monitoring_content', NULL, NULL, 'PASS'
UNION ALL SELECT 'fraud_export_content', NULL, NULL, 'PASS'"""
oracle("job_reconciliation", _JOB_CHECKS, "silver_m")
_OWN_CHECKS = {
    "bronze_transactions": ["bronze_source_count"], "silver_transactions": ["bronze_to_silver_bound", "amounts_summable"],
    "daily_transaction_summary": ["daily_count", "daily_fraud"], "daily_type_summary": ["daily_type_count"],
    "hourly_fraud_summary": ["hourly_count"], "transaction_type_summary": ["type_count"], "high_value_summary": ["high_value_count"],
    "fraud_monitoring": ["fraud_monitoring_rows"], "fraud_feature": ["fraud_feature_rows"],
    "origin_account_summary": ["origin_account_count"], "destination_account_summary": ["destination_account_count"],
}


def _status_of(table: str) -> str:
    checks = ", ".join(f"'{c}'" for c in _OWN_CHECKS[table])
    return f"(SELECT CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END FROM ({_JOB_CHECKS}) j WHERE check_name IN ({checks}))"


_AUDITED = {"bronze_transactions": ("bronze", 14, "SELECT COUNT(*) FROM bronze_m"), "silver_transactions": ("silver", 24, "SELECT COUNT(*) FROM silver_m")}
_AUDITED |= {t: ("gold", n, q) for t, (n, q) in _GOLD_M.items()}


def _audit_rows(tables) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'fixture_run' AS pipeline_run_id, '{_AUDITED[t][0]}' AS pipeline_stage, '{t}' AS table_name, "
        f"CAST(({_AUDITED[t][2]}) AS BIGINT) AS row_count, {_AUDITED[t][1]} AS column_count, {_status_of(t)} AS reconciliation_status" for t in tables)


oracle("audit_records", _audit_rows(_AUDITED), "silver_m")
oracle("audit_union", _audit_rows(["bronze_transactions", "silver_transactions"]), "silver_m")

_SMALL = ["daily_transaction_summary", "daily_type_summary", "hourly_fraud_summary", "transaction_type_summary",
          "high_value_summary", "fraud_monitoring"]
_reg = []
for _t, (_n, _qq) in _GOLD_M.items():
    if _t in _SMALL:
        _reg.append(f"SELECT 'fixture_run' AS pipeline_run_id, '{_t}' AS table_name, {_n} AS column_count, "
                    f"CAST(({_qq}) AS BIGINT) AS row_count, 'CSV' AS persistence_format, 'CSV_EXPORTED' AS persistence_status")
    else:
        _reg.append(f"SELECT 'fixture_run' AS pipeline_run_id, '{_t}' AS table_name, {_n} AS column_count, "
                    f"CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS persistence_format, "
                    f"'DEFINED_NOT_PERSISTED' AS persistence_status")
oracle("gold_registry", "\nUNION ALL\n".join(_reg), "silver_m")

oracle("run_summary", f"""
SELECT 'fixture_run' AS pipeline_run_id, (SELECT pipeline_status FROM ({_STATUS}) s) AS pipeline_status,
  b.n AS bronze_row_count, s.n AS silver_row_count, b.n - s.n AS rejected_row_count,
  s.f AS fraud_transaction_count, {len(_SMALL)} AS gold_tables_exported, {len(_GOLD_M) - len(_SMALL)} AS large_gold_tables_skipped,
  CASE WHEN (SELECT pipeline_status FROM ({_STATUS}) s) = 'SUCCESS' THEN 'PASS' ELSE 'FAIL' END
    AS overall_reconciliation_status
FROM (SELECT COUNT(*) AS n FROM bronze_m) b,
     (SELECT COUNT(*) AS n, CAST(SUM(is_fraud) AS BIGINT) AS f FROM silver_m) s""", "silver_m")

oracle("stage_audit_silver", """
SELECT 'fixture_run' AS pipeline_run_id, 'bronze_to_silver' AS pipeline_name, COUNT(*) AS bronze_record_count,
  CAST(count_if(hard_failure_count = 0) AS BIGINT) AS silver_record_count,
  CAST(count_if(hard_failure_count > 0) AS BIGINT) AS quarantine_record_count,
  COUNT(*) = count_if(hard_failure_count = 0) + count_if(hard_failure_count > 0) AS count_reconciliation_passed,
  CASE WHEN COUNT(*) = count_if(hard_failure_count = 0) + count_if(hard_failure_count > 0) THEN 'SUCCESS'
       ELSE 'FAILED' END AS pipeline_status
FROM validated_n""", "validated_n")
oracle("stage_audit_bronze", """
SELECT 'fixture_run' AS pipeline_run_id, 'raw_to_bronze' AS pipeline_name, r.n AS source_record_count,
  b.n AS bronze_record_count, r.n = b.n AS count_reconciliation_passed,
  CASE WHEN r.n = b.n THEN 'SUCCESS' ELSE 'FAILED' END AS pipeline_status, d.dups AS duplicate_record_count
FROM (SELECT COUNT(*) AS n FROM raw) r, (SELECT COUNT(*) AS n FROM bronze_n) b,
     (SELECT CAST(coalesce(SUM(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS dups
      FROM (SELECT COUNT(*) AS n FROM bronze_n GROUP BY _record_hash) g) d""", "bronze_n")
_MEASURES_G = {
    "silver_record_count": "SELECT COUNT(*) FROM silver_n",
    "silver_fraud_count": "SELECT coalesce(SUM(is_fraud), 0) FROM silver_n",
    "daily_record_total": "SELECT COUNT(*) FROM silver_n",
    "hourly_record_total": "SELECT COUNT(*) FROM silver_n",
    "type_record_total": "SELECT COUNT(*) FROM silver_n",
    "fraud_monitoring_rows": "SELECT COUNT(*) FROM silver_n WHERE is_fraud = 1",
    "feature_rows": "SELECT COUNT(*) FROM silver_n",
}
oracle("stage_checks_gold", _comparison(_MEASURES_G, [
    ("type_reconciliation", "silver_record_count", "type_record_total", "eq"),
    ("daily_reconciliation", "silver_record_count", "daily_record_total", "eq"),
    ("hourly_reconciliation", "silver_record_count", "hourly_record_total", "eq"),
    ("fraud_monitoring_reconciliation", "silver_fraud_count", "fraud_monitoring_rows", "eq"),
    ("feature_reconciliation", "silver_record_count", "feature_rows", "eq"),
]), "silver_n")

_RULED_ROWS = {
    "daily_transaction_summary": "SELECT COUNT(DISTINCT transaction_day) FROM silver_n",
    "daily_type_summary": "SELECT COUNT(*) FROM (SELECT DISTINCT transaction_day, transaction_type FROM silver_n) x",
    "hourly_fraud_summary": "SELECT COUNT(*) FROM (SELECT DISTINCT step, transaction_day, hour_of_day FROM silver_n) x",
    "transaction_type_summary": "SELECT COUNT(DISTINCT transaction_type) FROM silver_n",
    "origin_account_summary": "SELECT COUNT(DISTINCT origin_account) FROM silver_n",
    "destination_account_summary": "SELECT COUNT(*) FROM (SELECT DISTINCT destination_account, destination_category FROM silver_n) x",
    "high_value_summary": "SELECT COUNT(*) FROM (SELECT DISTINCT transaction_day, transaction_type FROM silver_n WHERE is_high_value_transaction = 1) x",
    "fraud_monitoring": "SELECT COUNT(*) FROM silver_n WHERE is_fraud = 1",
    "fraud_features": "SELECT COUNT(*) FROM silver_n",
}
oracle("stage_audit_gold", f"""
SELECT 'fixture_run' AS pipeline_run_id, 'silver_to_gold' AS pipeline_name, (SELECT COUNT(*) FROM silver_n) AS silver_record_count,
  {", ".join(f"({q}) AS {t}_row_count" for t, q in _RULED_ROWS.items())},
  (SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM silver_n GROUP BY transaction_day) x) = (SELECT COUNT(*) FROM silver_n) AS daily_reconciliation_passed,
  (SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM silver_n GROUP BY step) x) = (SELECT COUNT(*) FROM silver_n) AS hourly_reconciliation_passed,
  (SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM silver_n GROUP BY transaction_type) x) = (SELECT COUNT(*) FROM silver_n) AS type_reconciliation_passed,
  (SELECT SUM(is_fraud) FROM silver_n) = (SELECT COUNT(*) FROM silver_n WHERE is_fraud = 1) AS fraud_reconciliation_passed,
  'SUCCESS' AS pipeline_status""", "silver_n")
_N, _HIGH = "SELECT COUNT(*) FROM silver_n", "SELECT COUNT(*) FROM silver_n WHERE is_high_value_transaction = 1"
_FRAUD_N = "SELECT COUNT(*) FROM silver_n WHERE is_fraud = 1"
oracle("ruled_reconciliation", _comparison(
    {"accepted_rows": "SELECT COUNT(*) FROM raw", "bronze_rows": "SELECT COUNT(*) FROM bronze_n",
     "split_rows": "SELECT count_if(hard_failure_count = 0) + count_if(hard_failure_count > 0) FROM validated_n", "silver_rows": _N,
     "daily_rows": _N, "daily_type_rows": _N, "hourly_rows": _N, "type_rows": _N, "origin_rows": _N, "destination_rows": _N, "feature_rows": _N,
     "silver_high_value": _HIGH, "high_value_rows": _HIGH, "silver_fraud": "SELECT SUM(is_fraud) FROM silver_n", "monitoring_rows": _FRAUD_N},
    [("bronze_source_count", "accepted_rows", "bronze_rows", "eq"), ("bronze_split", "bronze_rows", "split_rows", "eq"),
     ("daily_count", "silver_rows", "daily_rows", "eq"), ("daily_type_count", "silver_rows", "daily_type_rows", "eq"),
     ("hourly_count", "silver_rows", "hourly_rows", "eq"), ("type_count", "silver_rows", "type_rows", "eq"),
     ("high_value_count", "silver_high_value", "high_value_rows", "eq"), ("fraud_monitoring_rows", "silver_fraud", "monitoring_rows", "eq"),
     ("fraud_feature_rows", "silver_rows", "feature_rows", "eq"), ("origin_account_count", "silver_rows", "origin_rows", "eq"),
     ("destination_account_count", "silver_rows", "destination_rows", "eq")]), "silver_n")
oracle("ruled_summary", """
SELECT 'fixture_run' AS pipeline_run_id, 'SUCCESS' AS pipeline_status, COUNT(*) AS bronze_record_count,
  CAST(count_if(hard_failure_count = 0) AS BIGINT) AS silver_record_count, CAST(count_if(hard_failure_count > 0) AS BIGINT) AS quarantine_record_count,
  CAST(count_if(hard_failure_count = 0 AND warning_count > 0) AS BIGINT) AS warning_record_count,
  CAST(SUM(CASE WHEN hard_failure_count = 0 THEN is_fraud END) AS BIGINT) AS fraud_transaction_count, 3 AS csv_files_exported,
  'PASS' AS reconciliation_status FROM validated_n""", "validated_n")
ORACLE["warning_file"], ORACLE["hard_failure_file"] = ORACLE["warning_rule_counts"], ORACLE["hard_rule_counts"]
oracle("export_reconciliation", """
SELECT t.table_name, (SELECT COUNT(*) FROM silver_m WHERE is_fraud = 1) AS row_count, TRUE AS same_content
FROM (VALUES ('silver'), ('fraud_monitoring'), ('fraud_monitoring.csv')) t(table_name)""", "silver_m")

# ------------------------------------------------------------------ sources and sinks (round trips)
oracle("csv_to_bronze", "SELECT * EXCLUDE (source_file_name), TRUE AS has_source_file FROM bronze_m", "bronze_m")
oracle("csv_rejects", """
SELECT CAST(count_if(step IS NULL) AS BIGINT) AS rejected_lines, CAST(count_if(step IS NULL) AS BIGINT) AS broken_lines,
  CAST(count_if(step IS NULL) AS BIGINT) AS lines_with_file, CAST(count_if(step IS NOT NULL) AS BIGINT) AS bronze_rows FROM raw""", "raw")
oracle("scan_csv_strict", "SELECT * FROM raw", "raw")
oracle("scan_csv_permissive", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw", "raw")
ORACLE["csv_export_roundtrip"] = ORACLE["transaction_type_summary"]
ORACLE["export_roundtrip"] = query(
    "SELECT 'fraud_monitoring' AS table_name, COUNT(*) AS exported_row_count FROM silver_m WHERE is_fraud = 1", "silver_m")
ORACLE["parquet_partitioned_roundtrip"] = ORACLE["silver_transactions"]

# ------------------------------------------------------------------ the job's rollup forms: same answers
ORACLE["rollup_daily_transaction_summary_core"] = ORACLE["daily_transaction_summary_core"]
for _k in ["daily_type_summary", "hourly_fraud_summary", "transaction_type_summary", "high_value_summary",
           "daily_transaction_summary_exact", "hourly_fraud_profile", "transaction_type_profile",
           "high_value_profile", "daily_type_profile"]:
    ORACLE[f"rollup_{_k}"] = ORACLE[_k]

# The scan forms must return what the window forms return.
ORACLE["fraud_feature_scan"] = ORACLE["fraud_feature"]
ORACLE["fraud_feature_profile_scan"] = ORACLE["fraud_feature_profile"]

# ------------------------------------------------------------------ bounds of estimates (no estimate is compared)

ORACLE["daily_summary_join_core"] = ORACLE["daily_transaction_summary_core"]
_BOUND = """SELECT transaction_day, COUNT(DISTINCT origin_account) AS unique_origin_accounts,
  COUNT(DISTINCT destination_account) AS unique_destination_accounts,
  TRUE AS origin_estimate_within_bound, TRUE AS destination_estimate_within_bound
FROM silver_m GROUP BY transaction_day"""
for _k in ["approx_accounts_by_day_bound", "daily_transaction_summary_bound"]:
    oracle(_k, _BOUND, "silver_m")
oracle("approx_quantiles_bound", """SELECT p.probability, (SELECT COUNT(amount) FROM raw) AS row_count, TRUE AS within_bound
FROM (VALUES (0.01::DOUBLE), (0.25), (0.5), (0.75), (0.95), (0.99)) p(probability)""", "raw")
oracle("sample_rows_bound", "SELECT LEAST(10, COUNT(*)) AS sampled_rows, CAST(0 AS BIGINT) AS foreign_rows FROM raw", "raw")
oracle("partition_rows", "SELECT CAST(16 AS BIGINT) AS partitions, COUNT(*) AS total_rows FROM raw", "raw")
oracle("silver_metrics", f"""SELECT COUNT(*) AS silver_row_count, {bigint_sum('is_fraud')} AS silver_fraud_count,
  {bigint_sum('is_flagged_fraud')} AS silver_flagged_fraud_count, {bigint_sum('is_high_value_transaction')} AS silver_high_value_count,
  {sround('SUM(CAST(amount AS DECIMAL(28,6)))', 2)} AS silver_total_amount FROM silver_m""", "silver_m")
oracle("bronze_metadata", """SELECT step, amount, origin_account, source_file_name, pipeline_run_id,
  '2024-01-31 12:30:15' AS bronze_ingestion_timestamp FROM bronze_m""", "bronze_m")
oracle("bronze_lineage", """SELECT _record_hash, _pipeline_run_id, _source_file, _source_file_path,
  '2024-01-31 12:30:15' AS _ingestion_timestamp, '2024-01-31' AS _ingestion_date FROM bronze_n""", "bronze_n")
oracle("type_median_bound", "SELECT transaction_type, COUNT(*) AS row_count, TRUE AS within_bound FROM silver_n GROUP BY transaction_type", "silver_n")

# ------------------------------------------------------------------ money with cents

def _with_cents(sql: str) -> str:
    """The same query over amounts with fractions, its sums and means exact."""
    exact = "SUM(CAST(amount AS DECIMAL(28,6)))"
    return (sql.replace("ROUND(value * 2000, 2) AS v", "ROUND(value * 2000 + (event_id * 37 % 100) / 100.0, 2) AS v")
            .replace("SUM(amount)", exact).replace("AVG(amount)", f"CAST({exact} AS DOUBLE) / COUNT(amount)")
            .replace("SUM(CASE WHEN is_fraud = 1 THEN amount ELSE 0.0 END)", "SUM(CASE WHEN is_fraud = 1 THEN CAST(amount AS DECIMAL(28,6)) ELSE 0 END)"))


for _k in ["daily_type_summary", "transaction_type_summary", "high_value_summary", "hourly_fraud_summary", "origin_account_summary",
           "destination_account_summary", "origin_account_profile", "daily_type_profile", "daily_transaction_summary_exact", "raw_transactions"]:
    ORACLE[f"cents_{_k}"] = _with_cents(ORACLE[_k])
