from obs_engine.operators.activities import (
    activity_flags,
    indoor_conditions,
    with_indoor_activity,
)
from obs_engine.operators.conditions import WEATHER_CATEGORIES, condition_counts
from obs_engine.operators.incremental import (
    extraction_window,
    high_water_mark,
    missing_keys,
    window_bounds,
    work_list,
)
from obs_engine.operators.intervals import (
    count_days,
    days_to_intervals,
    merge_intervals,
    outside_intervals,
    subtract_intervals,
)
from obs_engine.operators.joins import broadcast_if_small
from obs_engine.operators.merge import aligned, latest_per_key, matched_keys, merge_frames, merged_in_one_pass
from obs_engine.operators.ranking import (
    monthly_metrics,
    rank_metrics,
    rank_metrics_by_day,
    rank_metrics_by_month,
)
from obs_engine.operators.selection import (
    filter_latest_period,
    filter_regex_not,
    top_entities,
)
from obs_engine.operators.shaping import (
    explode_records,
    flatten_struct,
    nan_to_null,
    raw_or_rejected,
    raw_population,
    raw_weather,
    rejected_weather,
    union_by_name,
    widened,
)
from obs_engine.operators.states import (
    add_states,
    counts_of_states,
    metrics_of_states,
    month_states,
)

__all__ = [
    "WEATHER_CATEGORIES",
    "activity_flags",
    "add_states",
    "aligned",
    "broadcast_if_small",
    "condition_counts",
    "count_days",
    "counts_of_states",
    "days_to_intervals",
    "explode_records",
    "extraction_window",
    "filter_latest_period",
    "filter_regex_not",
    "flatten_struct",
    "high_water_mark",
    "indoor_conditions",
    "latest_per_key",
    "matched_keys",
    "merge_frames",
    "merge_intervals",
    "merged_in_one_pass",
    "metrics_of_states",
    "missing_keys",
    "month_states",
    "monthly_metrics",
    "nan_to_null",
    "outside_intervals",
    "rank_metrics",
    "rank_metrics_by_day",
    "rank_metrics_by_month",
    "raw_or_rejected",
    "raw_population",
    "raw_weather",
    "rejected_weather",
    "subtract_intervals",
    "top_entities",
    "union_by_name",
    "widened",
    "window_bounds",
    "with_indoor_activity",
    "work_list",
]
