from odometrix.functions.columns import (
    as_timestamp,
    clamp_min,
    flag_is_set,
    format_id,
    hour_of,
    make_label,
    nan_to_null,
    parse_date,
    parse_timestamp,
    round_half_even,
    safe_corr,
    shift_date,
    shift_time,
    timestamp_text,
    trunc_int,
    truncate_time,
)

__all__ = [
    "as_timestamp",
    "clamp_min",
    "flag_is_set",
    "format_id",
    "hour_of",
    "make_label",
    "nan_to_null",
    "parse_date",
    "parse_timestamp",
    "round_half_even",
    "safe_corr",
    "shift_date",
    "shift_time",
    "timestamp_text",
    "trunc_int",
    "truncate_time",
]
