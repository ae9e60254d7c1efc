"""Scalar and aggregate column expressions (Catalyst only, no UDFs)."""

from carelens.functions.expr import (  # noqa: F401
    CATEGORY_CODES,
    CONVERSION_PRIORITY,
    DAY_MICROS,
    NULL_KEY,
    age_days,
    code_map,
    day_index,
    desc_time_key,
    exact_mean,
    exact_sum,
    fill_missing,
    first_by_order,
    first_row_struct,
    floor_days,
    ieee_div,
    int_mean,
    latest_first_order,
    nan_to_null,
    ne_missing,
    norm_key,
    parse_ts,
    strict_int_key,
)
