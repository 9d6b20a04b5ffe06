"""Independent DuckDB SQL for every registered query (the correctness oracle).

The text is written from the reference's semantics, not generated from the
Spark code. Shared layers are CTEs; ``query(body, *ctes)`` stitches the ones a
query needs (dependencies first).
"""

from __future__ import annotations


def sround(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal text."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def safe_pct(num: str, den: str, digits: int = 6) -> str:
    return f"CASE WHEN ({den}) > 0 THEN {sround(f'({num}) / ({den}) * 100.0', digits)} ELSE 0.0 END"


def bigint_sum(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


# The fixture text, as given for the driver's events table (runs unchanged in both engines).
FIXTURE = """
WITH b AS (
  SELECT event_id AS id, CAST(user_id AS BIGINT) AS u, event_type AS et,
         CAST(day(ts) * 24 + hour(ts) - 23 AS INT) AS s,
         ROUND(value * 2000, 2) AS v
  FROM events
), d AS (
  SELECT id, u, et,
    CASE WHEN id % 211 = 7 THEN NULL WHEN id % 223 = 9 THEN 0 WHEN id % 227 = 11 THEN 800 ELSE s END AS step,
    CASE WHEN id % 199 = 3 THEN 'BOGUS' WHEN id % 229 = 13 THEN NULL
         WHEN id % 167 = 10 THEN ' transfer '
         WHEN et = 'signup' THEN 'CASH_IN' WHEN et = 'click' THEN 'CASH_OUT' WHEN et = 'error' THEN 'DEBIT'
         WHEN et = 'view' THEN 'PAYMENT' ELSE 'TRANSFER' END AS type,
    CASE WHEN id % 197 = 5 THEN -v WHEN id % 233 = 15 THEN NULL WHEN id % 193 = 17 THEN CAST(0 AS DOUBLE)
         WHEN id % 191 = 2 THEN CAST(200000 AS DOUBLE) ELSE v END AS amount,
    CASE WHEN id % 173 = 8 THEN 'M5' ELSE CONCAT('C', CAST(u AS STRING)) END AS nameOrig,
    CAST((id % 50) * 10000 AS DOUBLE) AS oldbalanceOrg,
    CASE WHEN id % 179 = 6 THEN 'X12' WHEN id % 181 = 4 THEN CONCAT('C', CAST(u AS STRING))
         WHEN et = 'view' THEN CONCAT('M', CAST(id % 97 AS STRING))
         ELSE CONCAT('C', CAST(1000 + id % 89 AS STRING)) END AS nameDest,
    CASE WHEN et = 'view' THEN CAST(0 AS DOUBLE) ELSE CAST((id % 40) * 5000 AS DOUBLE) END AS oldbalanceDest
  FROM b
), e AS (
  SELECT id, step, type, amount, nameOrig, oldbalanceOrg,
    CASE WHEN id % 7 = 0 THEN oldbalanceOrg WHEN type = 'CASH_IN' THEN ROUND(oldbalanceOrg + amount, 2)
         WHEN oldbalanceOrg >= amount THEN ROUND(oldbalanceOrg - amount, 2) ELSE CAST(0 AS DOUBLE) END AS newbalanceOrig,
    nameDest, oldbalanceDest,
    CASE WHEN et = 'view' AND id % 163 = 12 THEN CAST(10 AS DOUBLE) WHEN et = 'view' THEN CAST(0 AS DOUBLE)
         ELSE ROUND(oldbalanceDest + amount, 2) END AS newbalanceDest,
    CASE WHEN id % 157 = 14 THEN 2 WHEN type IN ('TRANSFER', 'CASH_OUT') AND id % 23 = 0 THEN 1
         WHEN id % 409 = 1 THEN 1 ELSE 0 END AS isFraud,
    CASE WHEN id % 139 = 20 THEN 3 WHEN id % 241 = 19 THEN NULL
         WHEN type = 'TRANSFER' AND amount > 200000 AND id % 5 = 0 THEN 1
         WHEN id % 149 = 18 THEN 1 ELSE 0 END AS isFlaggedFraud
  FROM d
)
SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM e
UNION ALL
SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM e WHERE id % 500 = 1
"""

RAW_COLS = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
            "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]

HASH = "sha256(concat_ws('||', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in RAW_COLS) + "))"

BRONZE_M = """
SELECT step, type AS transaction_type, amount, nameOrig AS origin_account,
       oldbalanceOrg AS origin_old_balance, newbalanceOrig AS origin_new_balance,
       nameDest AS destination_account, oldbalanceDest AS destination_old_balance,
       newbalanceDest AS destination_new_balance, isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud,
       'events.parquet' AS source_file_name, 'fixture_run' AS pipeline_run_id
FROM raw
"""

SILVER_M = f"""
SELECT *,
  CAST(floor((step - 1) / 24.0) + 1 AS INTEGER) AS transaction_day,
  CAST((((step - 1) % 24) + 24) % 24 AS INTEGER) AS transaction_hour,
  {sround('origin_old_balance - origin_new_balance', 2)} AS origin_balance_change,
  {sround('destination_new_balance - destination_old_balance', 2)} AS destination_balance_change,
  {sround('origin_old_balance - amount - origin_new_balance', 2)} AS origin_balance_error,
  {sround('destination_old_balance + amount - destination_new_balance', 2)} AS destination_balance_error,
  CASE WHEN amount >= 200000.0 THEN 1 ELSE 0 END AS is_high_value_transaction,
  CASE WHEN amount = 0 THEN 1 ELSE 0 END AS is_zero_amount_transaction,
  CASE WHEN starts_with(origin_account, 'M') THEN 1 ELSE 0 END AS is_origin_merchant,
  CASE WHEN starts_with(destination_account, 'M') THEN 1 ELSE 0 END AS is_destination_merchant
FROM bronze_m
WHERE step IS NOT NULL AND step > 0
  AND transaction_type IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')
  AND amount IS NOT NULL AND amount >= 0
  AND origin_account IS NOT NULL AND destination_account IS NOT NULL
  AND is_fraud IN (0, 1) AND is_flagged_fraud IN (0, 1)
"""

# Strict Silver plus the record hash, used for deterministic window order.
SILVER_MH = f"""
SELECT *, sha256(concat_ws('||', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in [
    "step", "transaction_type", "amount", "origin_account", "origin_old_balance", "origin_new_balance",
    "destination_account", "destination_old_balance", "destination_new_balance", "is_fraud", "is_flagged_fraud"])})) AS _record_hash
FROM silver_m
"""

BRONZE_N = f"""
SELECT *, 'fixture_run' AS _pipeline_run_id, 'events.parquet' AS _source_file,
       'events.parquet' AS _source_file_path, {HASH} AS _record_hash
FROM raw
"""

# Renamed + normalized + enriched (ruled profile).
ENRICHED_N = """
SELECT _record_hash, _pipeline_run_id, _source_file, _source_file_path,
  step, upper(trim(type)) AS transaction_type, amount,
  trim(nameOrig) AS origin_account, oldbalanceOrg AS old_balance_origin, newbalanceOrig AS new_balance_origin,
  trim(nameDest) AS destination_account, oldbalanceDest AS old_balance_destination,
  newbalanceDest AS new_balance_destination, isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud
FROM bronze_n
"""

ENRICHED2_N = """
SELECT *,
  CAST(ceil(step / 24.0) AS INTEGER) AS transaction_day,
  CAST((step - 1) % 24 AS INTEGER) AS hour_of_day,
  CASE WHEN starts_with(destination_account, 'M') THEN 'MERCHANT'
       WHEN starts_with(destination_account, 'C') THEN 'CUSTOMER' ELSE 'UNKNOWN' END AS destination_category,
  CASE WHEN amount = 0 THEN 'ZERO' WHEN amount < 1000 THEN 'LOW' WHEN amount < 50000 THEN 'MEDIUM'
       WHEN amount <= 200000 THEN 'HIGH' ELSE 'VERY_HIGH' END AS amount_category,
  CAST(amount > 200000.0 AS INTEGER) AS is_high_value_transaction,
  CAST(amount = 0 AS INTEGER) AS is_zero_amount,
  CAST(origin_account = destination_account AS INTEGER) AS is_self_transfer
FROM enriched_n
"""

_HARD = [
    ("MISSING_CRITICAL_FIELD", "fail_missing_critical_field",
     "CAST((step IS NULL OR transaction_type IS NULL OR amount IS NULL OR origin_account IS NULL "
     "OR destination_account IS NULL OR is_fraud IS NULL OR is_flagged_fraud IS NULL) AS INTEGER)"),
    ("INVALID_TRANSACTION_TYPE", "fail_invalid_transaction_type",
     "CASE WHEN transaction_type IN ('CASH_IN','CASH_OUT','DEBIT','PAYMENT','TRANSFER') THEN 0 ELSE 1 END"),
    ("INVALID_STEP", "fail_invalid_step", "CASE WHEN step BETWEEN 1 AND 744 THEN 0 ELSE 1 END"),
    ("NEGATIVE_AMOUNT", "fail_negative_amount", "CASE WHEN amount < 0 THEN 1 ELSE 0 END"),
    ("INVALID_FRAUD_FLAG", "fail_invalid_fraud_flag", "CASE WHEN is_fraud IN (0, 1) THEN 0 ELSE 1 END"),
    ("INVALID_FLAGGED_FRAUD", "fail_invalid_flagged_fraud", "CASE WHEN is_flagged_fraud IN (0, 1) THEN 0 ELSE 1 END"),
    ("INVALID_ORIGIN_ACCOUNT", "fail_invalid_origin_account",
     "CASE WHEN regexp_matches(origin_account, '^C[0-9]+$') THEN 0 ELSE 1 END"),
    ("INVALID_DESTINATION_ACCOUNT", "fail_invalid_destination_account",
     "CASE WHEN regexp_matches(destination_account, '^[CM][0-9]+$') THEN 0 ELSE 1 END"),
]

_WARN = [
    ("ZERO_AMOUNT", "warn_zero_amount", "CASE WHEN amount = 0 THEN 1 ELSE 0 END"),
    ("SELF_TRANSFER", "warn_self_transfer", "CASE WHEN origin_account = destination_account THEN 1 ELSE 0 END"),
    ("ORIGIN_BALANCE_MISMATCH", "warn_origin_balance_mismatch",
     "CASE WHEN transaction_type IN ('PAYMENT','TRANSFER','CASH_OUT','DEBIT') "
     "AND abs(old_balance_origin - amount - new_balance_origin) > 0.01 THEN 1 ELSE 0 END"),
    ("CASH_IN_BALANCE_MISMATCH", "warn_cash_in_balance_mismatch",
     "CASE WHEN transaction_type = 'CASH_IN' AND abs(old_balance_origin + amount - new_balance_origin) > 0.01 "
     "THEN 1 ELSE 0 END"),
    ("HIGH_VALUE_TRANSFER_NOT_FLAGGED", "warn_high_value_transfer_not_flagged",
     "CASE WHEN transaction_type = 'TRANSFER' AND amount > 200000.0 AND is_flagged_fraud = 0 THEN 1 ELSE 0 END"),
    ("FLAGGED_RULE_MISMATCH", "warn_flagged_transaction_rule_mismatch",
     "CASE WHEN is_flagged_fraud = 1 AND (transaction_type <> 'TRANSFER' OR amount <= 200000.0) THEN 1 ELSE 0 END"),
    ("MERCHANT_BALANCE_ANOMALY", "warn_merchant_balance_anomaly",
     "CASE WHEN destination_category = 'MERCHANT' AND (old_balance_destination <> 0 OR new_balance_destination <> 0) "
     "THEN 1 ELSE 0 END"),
]

HARD_RULES = _HARD
WARNING_RULES = _WARN

RULED_N = (
    "SELECT *, "
    + ", ".join(f"{expr} AS {name}" for _, name, expr in _HARD + _WARN)
    + " FROM enriched2_n"
)


def _reason_list(rules) -> str:
    items = ", ".join(f"CASE WHEN {name} = 1 THEN '{code}' END" for code, name, _ in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


VALIDATED_N = f"""
SELECT *,
  CASE WHEN hard_failure_count > 0 THEN 'QUARANTINE' WHEN warning_count > 0 THEN 'VALID_WITH_WARNING'
       ELSE 'VALID' END AS validation_status
FROM (
  SELECT *,
    CAST({' + '.join(n for _, n, _ in _HARD)} AS INTEGER) AS hard_failure_count,
    CAST({' + '.join(n for _, n, _ in _WARN)} AS INTEGER) AS warning_count,
    array_to_string({_reason_list(_HARD)}, '|') AS hard_failure_reason_text,
    array_to_string({_reason_list(_WARN)}, '|') AS warning_reason_text,
    len({_reason_list(_HARD)}) AS hard_failure_reason_count,
    len({_reason_list(_WARN)}) AS warning_reason_count
  FROM ruled_n
) t
"""

SILVER_N = """
SELECT *,
  CAST(destination_category = 'CUSTOMER' AS INTEGER) AS is_customer_destination,
  CAST(destination_category = 'MERCHANT' AS INTEGER) AS is_merchant_destination,
  CASE WHEN destination_category = 'MERCHANT' THEN 0 ELSE 1 END AS destination_balance_available
FROM validated_n WHERE hard_failure_count = 0
"""

QUARANTINE_N = "SELECT * FROM validated_n WHERE hard_failure_count > 0"

CTES = {
    "raw": (FIXTURE, []),
    "bronze_m": (BRONZE_M, ["raw"]),
    "silver_m": (SILVER_M, ["bronze_m"]),
    "silver_mh": (SILVER_MH, ["silver_m"]),
    "bronze_n": (BRONZE_N, ["raw"]),
    "enriched_n": (ENRICHED_N, ["bronze_n"]),
    "enriched2_n": (ENRICHED2_N, ["enriched_n"]),
    "ruled_n": (RULED_N, ["enriched2_n"]),
    "validated_n": (VALIDATED_N, ["ruled_n"]),
    "silver_n": (SILVER_N, ["validated_n"]),
    "quarantine_n": (QUARANTINE_N, ["validated_n"]),
}


def _resolve(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def query(body: str, *ctes: str) -> str:
    """``WITH <needed CTEs> <body>``; body is a full SELECT over the CTE names."""
    names = _resolve(ctes)
    if not names:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n][0]})" for n in names)
    return f"WITH {parts}\n{body.strip()}"
