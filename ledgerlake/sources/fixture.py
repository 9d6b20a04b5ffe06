"""Driver ``events`` table -> the 11-column raw transaction table.

The driver ships no transaction CSV, so ``events`` is mapped onto the raw
schema with deterministic defects (NULLs, out-of-range steps, unknown or
untrimmed types, negative / zero / threshold amounts, malformed accounts,
self transfers, non-binary flags, merchant balances, exact duplicates).
The mapping is one projection over ``events`` (duplicates come from a
generator, not a second scan), so it scales with the table and keeps parquet
column pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import RAW_COLUMNS

# Fixed values of the fixture mapping: (modulus, residue) pairs selecting the
# injected defects, the amount scale and the duplicate selector.
AMOUNT_SCALE = 2000
DUPLICATE_EVERY = (500, 1)


def _hit(col: Column, modulus: int, residue: int) -> Column:
    return (col % modulus) == residue


def _d(x: float) -> Column:
    return F.lit(float(x))


def raw_from_events(events: DataFrame, cents: bool = False) -> DataFrame:
    """Map an ``events`` DataFrame onto the raw transaction schema (with duplicates).

    The mapped amounts are whole; with ``cents`` each event adds a fraction of its own.
    """
    i = F.col("event_id")
    et = F.col("event_type")
    u = F.col("user_id").cast("bigint")
    base_step = (F.dayofmonth("ts") * 24 + F.hour("ts") - 23).cast("int")
    v = F.round(F.col("value") * AMOUNT_SCALE + (i * 37 % 100 / 100.0 if cents else _d(0)), 2)

    step = (
        F.when(_hit(i, 211, 7), F.lit(None).cast("int"))
        .when(_hit(i, 223, 9), F.lit(0))
        .when(_hit(i, 227, 11), F.lit(800))
        .otherwise(base_step)
    )
    ttype = (
        F.when(_hit(i, 199, 3), F.lit("BOGUS"))
        .when(_hit(i, 229, 13), F.lit(None).cast("string"))
        .when(_hit(i, 167, 10), F.lit(" transfer "))
        .when(et == "signup", F.lit("CASH_IN"))
        .when(et == "click", F.lit("CASH_OUT"))
        .when(et == "error", F.lit("DEBIT"))
        .when(et == "view", F.lit("PAYMENT"))
        .otherwise(F.lit("TRANSFER"))
    )
    amount = (
        F.when(_hit(i, 197, 5), -v)
        .when(_hit(i, 233, 15), F.lit(None).cast("double"))
        .when(_hit(i, 193, 17), _d(0))
        .when(_hit(i, 191, 2), _d(200000))
        .otherwise(v)
    )
    name_orig = F.when(_hit(i, 173, 8), F.lit("M5")).otherwise(F.concat(F.lit("C"), u.cast("string")))
    old_orig = ((i % 50) * 10000).cast("double")
    name_dest = (
        F.when(_hit(i, 179, 6), F.lit("X12"))
        .when(_hit(i, 181, 4), F.concat(F.lit("C"), u.cast("string")))
        .when(et == "view", F.concat(F.lit("M"), (i % 97).cast("string")))
        .otherwise(F.concat(F.lit("C"), (F.lit(1000) + i % 89).cast("string")))
    )
    old_dest = F.when(et == "view", _d(0)).otherwise(((i % 40) * 5000).cast("double"))

    d = events.select(
        i.alias("id"), et.alias("et"), step.alias("step"), ttype.alias("type"),
        amount.alias("amount"), name_orig.alias("nameOrig"), old_orig.alias("oldbalanceOrg"),
        name_dest.alias("nameDest"), old_dest.alias("oldbalanceDest"),
    )

    i, et = F.col("id"), F.col("et")
    t, a, ob = F.col("type"), F.col("amount"), F.col("oldbalanceOrg")
    new_orig = (
        F.when(_hit(i, 7, 0), ob)
        .when(t == "CASH_IN", F.round(ob + a, 2))
        .when(ob >= a, F.round(ob - a, 2))
        .otherwise(_d(0))
    )
    new_dest = (
        F.when((et == "view") & _hit(i, 163, 12), _d(10))
        .when(et == "view", _d(0))
        .otherwise(F.round(F.col("oldbalanceDest") + a, 2))
    )
    is_fraud = (
        F.when(_hit(i, 157, 14), F.lit(2))
        .when(t.isin("TRANSFER", "CASH_OUT") & _hit(i, 23, 0), F.lit(1))
        .when(_hit(i, 409, 1), F.lit(1))
        .otherwise(F.lit(0))
    )
    is_flagged = (
        F.when(_hit(i, 139, 20), F.lit(3))
        .when(_hit(i, 241, 19), F.lit(None).cast("int"))
        .when((t == "TRANSFER") & (a > 200000) & _hit(i, 5, 0), F.lit(1))
        .when(_hit(i, 149, 18), F.lit(1))
        .otherwise(F.lit(0))
    )
    e = d.select(
        "id", "step", "type", "amount", "nameOrig", "oldbalanceOrg",
        new_orig.alias("newbalanceOrig"), "nameDest", "oldbalanceDest",
        new_dest.alias("newbalanceDest"), is_fraud.alias("isFraud"), is_flagged.alias("isFlaggedFraud"),
    )
    # Exact duplicates: selected events are emitted twice by a generator, so the
    # source is scanned once (same bag of rows as a UNION ALL of the copies).
    modulus, residue = DUPLICATE_EVERY
    copies = F.when(_hit(F.col("id"), modulus, residue), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return e.select(*RAW_COLUMNS, F.explode(copies).alias("_copy")).select(*RAW_COLUMNS)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str, cents: bool = False) -> DataFrame:
    """The raw 11-column transaction table for one scale-factor folder."""
    return raw_from_events(read_events(spark, sf_dir), cents)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Any driver table by name, e.g. ``orders`` or ``customer``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
