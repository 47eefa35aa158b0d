from odometrix.operators.asof import asof_join
from odometrix.operators.incremental import DailyPartials, merge_moments, moments, profile_of
from odometrix.operators.ingest import (
    flatten_tires,
    to_silver_environment,
    to_silver_fleet,
    to_silver_maintenance,
    to_silver_sensor,
)
from odometrix.operators.ordering import with_position
from odometrix.operators.profile import (
    FlagRule,
    deviation_flags,
    deviation_profile,
    engine_temp_flags,
    profile_and_counts,
    readings_for,
    with_profile,
)
from odometrix.operators.reports import (
    breakdown_logs,
    abnormalities_by_tag,
    breakdowns_by_label,
    event_count_by_key,
    flagged_readings_with_tags,
    repairs_vs_usage,
    top_n,
    usage_correlation,
    usage_range_by_key,
)
from odometrix.operators.rules import (
    NOMINAL_RANGES,
    apply_tag_rules,
    range_fault_counts,
    range_faults,
)
from odometrix.operators.scan import prefix_scan, previous_values
from odometrix.operators.series import (
    clamped_running_total,
    distance_travelled,
    last_per_period,
    missing_periods,
    opening_values,
    running_total,
)

__all__ = [
    "NOMINAL_RANGES",
    "DailyPartials",
    "FlagRule",
    "abnormalities_by_tag",
    "apply_tag_rules",
    "asof_join",
    "breakdown_logs",
    "breakdowns_by_label",
    "clamped_running_total",
    "deviation_flags",
    "deviation_profile",
    "distance_travelled",
    "engine_temp_flags",
    "event_count_by_key",
    "flagged_readings_with_tags",
    "flatten_tires",
    "last_per_period",
    "merge_moments",
    "missing_periods",
    "moments",
    "opening_values",
    "prefix_scan",
    "previous_values",
    "profile_and_counts",
    "profile_of",
    "range_fault_counts",
    "range_faults",
    "readings_for",
    "repairs_vs_usage",
    "running_total",
    "to_silver_environment",
    "to_silver_fleet",
    "to_silver_maintenance",
    "to_silver_sensor",
    "top_n",
    "usage_correlation",
    "usage_range_by_key",
    "with_position",
    "with_profile",
]
