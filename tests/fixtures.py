"""Small hand-built inputs for unit tests (the registered queries use driver tables)."""

from pyspark.sql import types as T

from ledgerlake.contracts import RAW_TRANSACTION_SCHEMA

# Four canonical transactions with hand-checked expectations.
UNIT_ROWS = [
    (1, "PAYMENT", 100.0, "C001", 1000.0, 900.0, "M001", 0.0, 0.0, 0, 0),
    (2, "TRANSFER", 300000.0, "C002", 500000.0, 200000.0, "C003", 0.0, 300000.0, 1, 1),
    (25, "CASH_OUT", 500.0, "C002", 200000.0, 199500.0, "C004", 0.0, 500.0, 1, 0),
    (26, "CASH_IN", 0.0, "C005", 1000.0, 1000.0, "C006", 100.0, 100.0, 0, 0),
]
REJECTED_ROW = (3, "PAYMENT", -10.0, "C007", 100.0, 110.0, "M002", 0.0, 0.0, 0, 0)

NULLABLE_RAW_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_TRANSACTION_SCHEMA.fields])


def unit_raw(spark, extra=()):
    return spark.createDataFrame(list(UNIT_ROWS) + list(extra), NULLABLE_RAW_SCHEMA)
