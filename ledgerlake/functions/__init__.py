"""Column-expression building blocks shared by all layers."""

from ledgerlake.functions.columns import (  # noqa: F401
    count_where,
    day_from_step,
    day_from_step_ceil,
    distinct_sketch,
    exact_amount,
    failing,
    flag,
    hour_from_step,
    hour_from_step_mod,
    money_avg,
    money_max,
    money_min,
    money_total,
    record_hash,
    safe_pct,
    sketch_bits,
    sketch_median,
    strict_flag,
    sum_where,
)
