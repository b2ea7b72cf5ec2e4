from .changes import apply_change_feed, change_feed, changed_keys, classify, duplicate_keys
from .filters import above_average, between_days, in_month, on_day, on_previous_day
from .joins import join_on, join_using
from .scd import (
    scd1_merge,
    scd2_init,
    scd2_merge,
    scd2_step,
    scd4_current,
    scd4_history,
    scd4_init,
)

__all__ = [
    "above_average",
    "apply_change_feed",
    "between_days",
    "change_feed",
    "changed_keys",
    "classify",
    "duplicate_keys",
    "in_month",
    "join_on",
    "join_using",
    "on_day",
    "on_previous_day",
    "scd1_merge",
    "scd2_init",
    "scd2_merge",
    "scd2_step",
    "scd4_current",
    "scd4_history",
    "scd4_init",
]
