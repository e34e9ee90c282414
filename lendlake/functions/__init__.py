"""Scalar column expressions shared by the operators."""

from lendlake.functions.columns import (  # noqa: F401
    all_null,
    any_null,
    band_label,
    band_order,
    decimal_median,
    is_conflict,
    mean_of,
    null_to_segment,
    rate_of,
    ratio,
    sentinel_flag,
    sentinel_to_null,
    sign_group,
    split_label,
    when_chain,
)
