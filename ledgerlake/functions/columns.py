"""Reusable Column expressions. All JVM-side built-ins: they stay inside
whole-stage codegen and compose into one projection per layer."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.contracts import HASH_NULL_TOKEN, HASH_SEPARATOR

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def strict_flag(condition: Column) -> Column:
    """Null-safe rule flag: NULL condition -> 0; int typed."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def failing(valid_when: Column) -> Column:
    """Rule flag for a positive validity test: NULL counts as a failure."""
    return (~F.coalesce(valid_when, F.lit(False))).cast("int")


def safe_pct(numerator: ColumnLike, denominator: ColumnLike, precision: int = 6) -> Column:
    """``den > 0 ? round(num / den * 100, p) : 0.0``; a NULL denominator gives 0.0."""
    num, den = col(numerator), col(denominator)
    return F.when(den > 0, F.round(num / den * F.lit(100.0), precision)).otherwise(F.lit(0.0))


def exact_amount(c: ColumnLike = "amount") -> Column:
    """A money value as decimal: its sums don't depend on the order of addition. Not finite -> NULL."""
    return col(c).try_cast("decimal(28,6)")


def money_total(c: ColumnLike = "amount") -> Column:
    return F.round(F.sum(exact_amount(c)), 2).cast("double")


def money_avg(c: ColumnLike = "amount") -> Column:
    """The exact sum over the number of values (NULLs are none), rounded once."""
    return F.round(F.try_divide(F.sum(exact_amount(c)).cast("double"), F.count(exact_amount(c))), 2)


def money_min(c: ColumnLike = "amount") -> Column:
    return F.round(F.min(col(c)), 2)


def money_max(c: ColumnLike = "amount") -> Column:
    return F.round(F.max(col(c)), 2)


#: Size of a median's sketch: about 0.05 % of the ranks off at most, exact up to some thousand values.
MEDIAN_SKETCH = 8192


def sketch_median(c: ColumnLike = "amount") -> Column:
    """Median estimated by a KLL sketch: a few ten KB a group at any number of values, merged across tasks."""
    value = col(c).cast("double")
    sketch = F.kll_sketch_agg_double(value, F.lit(MEDIAN_SKETCH))
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))


def distinct_sketch(c: ColumnLike, rsd: float) -> Column:
    """HyperLogLog state whose estimate has about the relative standard deviation ``rsd``; states can be merged."""
    return F.hll_sketch_agg(col(c), F.lit(sketch_bits(rsd)))


def sketch_bits(rsd: float) -> int:
    """log2 of the registers: the error is 1.04 over the root of their number."""
    return min(21, max(4, ceil(2 * log2(1.04 / rsd))))


def sum_where(condition: Column, value: ColumnLike = "amount") -> Column:
    """Conditional money sum, 0.0 where the condition fails, rounded to 2."""
    return F.round(F.sum(F.when(condition, exact_amount(value)).otherwise(F.lit(0).cast("decimal(28,6)"))), 2).cast("double")


def count_where(condition: Column) -> Column:
    """Conditional count as bigint (NULL conditions are not counted)."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the source columns as text, NULL -> a fixed token."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def day_from_step(step: ColumnLike = "step") -> Column:
    """1-based day of a 1-based hour index: floor((step - 1) / 24) + 1."""
    return (F.floor((col(step) - F.lit(1)) / F.lit(24)) + F.lit(1)).cast("int")


def hour_from_step(step: ColumnLike = "step") -> Column:
    """Hour of day 0..23 (non-negative modulus)."""
    return F.pmod(col(step) - F.lit(1), F.lit(24)).cast("int")


def day_from_step_ceil(step: ColumnLike = "step") -> Column:
    """Ruled-profile day: ceil(step / 24)."""
    return F.ceil(col(step) / F.lit(24)).cast("int")


def hour_from_step_mod(step: ColumnLike = "step") -> Column:
    """Ruled-profile hour: (step - 1) % 24, sign kept for step <= 0."""
    return ((col(step) - F.lit(1)) % F.lit(24)).cast("int")
